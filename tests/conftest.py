from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from actiontally.session import build_session

    s = build_session("local[*]", app="actiontally-tests", shuffle_partitions=8,
                      extra={"spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark, request):
    from actiontally.session import scratch_path

    return scratch_path(spark, f"test-{request.node.name[:40]}")


@pytest.fixture(scope="session")
def landed_lake(spark):
    """The sf0.001 events landed once in a lake (bucket directories on, to prune the most)."""
    from actiontally.plans.fixtures import plain_events
    from actiontally.session import scratch_path
    from actiontally.sources.lake import write_lake

    path = scratch_path(spark, "test-landed-lake")
    write_lake(plain_events(spark, SF001), path, time_col="ts", bucket_dirs=True)
    return path

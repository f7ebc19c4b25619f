"""Every registered query against its DuckDB oracle (the driver's correctness gate)."""

from __future__ import annotations

import duckdb
import pytest

from tests.conftest import SF01
from tools.compare import TABLES, digest

from actiontally.plans.catalog import QUERIES
from actiontally.plans.oracle import ORACLE_SQL


# Spark type → DuckDB result type, for the types the queries produce.
DUCK = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
        "timestamp_ntz": "TIMESTAMP", "date": "DATE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF01}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF01)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLE_SQL[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    otypes = {d[0]: str(d[1]) for d in res.description}
    assert {f.name: DUCK.get(f.dataType.simpleString()) for f in df.schema.fields} == otypes
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_entry_smoke(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.columns == ["user_id", "window_start", "window_end", "total_actions", "aggregation_type"]
    assert df.count() > 0

"""Session settings and the shared scratch area.

All intermediate tables (lake copies, change logs, stream checkpoints) go under the
directory the cluster names in ``spark.checkpoint.dir``.  A private directory is
created only when that setting is absent and Spark runs in local mode (tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job in this package relies on.  (Dynamic partition overwrite is set per
# write by the lake writer, not for the whole session.)
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str | None = None, app: str = "actiontally",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    pin_utc(spark)
    return spark


def pin_utc(spark: SparkSession) -> None:
    """Window edges of TIMESTAMP columns depend on the session zone; event times are UTC.
    This sets the caller's session zone and leaves it so, as results are lazy and are
    evaluated under it."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


#: Bytes of rows that a Python worker gets at once.
ARROW_BYTES = 2 << 20
_ARROW_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_arrow(spark: SparkSession) -> None:
    """Rows go to Python workers in batches of about ``ARROW_BYTES``, if the caller set no size. Spark's own
    bound (64 MB or 10,000 rows) lets each task hold tens of MB of texts outside the heap and again in Python,
    and the processes keep that memory for the steps that follow. Like the zone, the setting is left so, as
    results are lazy and are evaluated under it."""
    if _ARROW_LIMIT not in spark.conf.getAll:
        spark.conf.set(_ARROW_LIMIT, str(ARROW_BYTES))


def checkpoint_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared directory before running on a cluster")
        root = tempfile.mkdtemp(prefix="actiontally-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh directory name under the shared checkpoint root (never reused)."""
    return f"{checkpoint_root(spark)}/actiontally/{label}-{uuid.uuid4().hex[:12]}"

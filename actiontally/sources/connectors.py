"""Topic and JDBC adapters over Spark's own connectors.

The Kafka and JDBC driver jars are not bundled; these functions fail with Spark's
own error when they are missing.  Everything downstream takes the ``value`` text
column, so file-fed streams exercise the same decode and aggregation code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: topic name of the action events.
TOPIC = "user_actions_topic"


def read_topic(spark: SparkSession, bootstrap: str, topic: str = TOPIC, starting_offsets: str = "earliest",
               fail_on_data_loss: bool = True, max_offsets_per_trigger: int | None = None, min_partitions: int | None = None) -> DataFrame:
    """The topic as a stream of ``value`` texts.  A new query starts at the topic's earliest
    record (``starting_offsets``), and records that expired before they were read stop it
    (``fail_on_data_loss``) rather than go missing unseen.  ``max_offsets_per_trigger`` bounds a
    micro-batch; ``min_partitions`` splits each topic partition's offset range over
    several tasks, so parallelism is not capped at the topic's partition count."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap)
              .option("subscribe", topic)
              .option("startingOffsets", starting_offsets)
              .option("failOnDataLoss", str(fail_on_data_loss).lower()))
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", str(max_offsets_per_trigger))
    if min_partitions:
        reader = reader.option("minPartitions", str(min_partitions))
    return reader.load().select(F.col("value").cast("string").alias("value"),
                                F.col("timestamp").alias("kafka_timestamp"))


def write_topic(encoded: DataFrame, bootstrap: str, topic: str = TOPIC) -> None:
    """Publish rows of an ``encode_json`` result (column ``value``) to a topic."""
    (encoded.select("value").write.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap).option("topic", topic).save())


def jdbc_exporter(url: str, table: str, properties: dict | None = None, batch_size: int = 10_000):
    """A callable for ``write_changes(export=...)`` that appends to a JDBC table.  It is given
    exactly the serving table's columns."""
    def export(df: DataFrame) -> None:
        w = df.write.format("jdbc").option("url", url).option("dbtable", table) \
            .option("batchsize", str(batch_size)).mode("append")
        for k, v in (properties or {}).items():
            w = w.option(k, v)
        w.save()
    return export

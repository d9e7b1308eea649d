"""High-water marks of finished slices, and the messages that came too late for theirs.

A slice reads the messages stamped in ``[start, stop)`` that the topic holds when it runs.  A
message stamped inside it that is written later is in no later slice either.  For each
finished slice the largest offset of every partition is kept; a message stamped inside
the slice with a larger offset was not there when the slice ran.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.landing import Run, append_once, read_landing
from tidemark.sources.kafka import slice_envelope

MARKS = "kafka_topic string, kafka_partition int, start_ms long, stop_ms long, high long"
#: Slices and messages meet by topic and by time in steps of this many milliseconds.
STEP_MS = 3_600_000


def mark_slice(spark: SparkSession, path: str, topic: str, envelope: DataFrame, start_ms: int, stop_ms: int) -> None:
    """Keep the marks of a slice that has run over ``envelope``; the first run of a slice counts.

    A row without partition says that the slice ran, also where a partition had no message.
    """
    rows = slice_envelope(envelope.where(F.col("kafka_topic") == topic), start_ms, stop_ms)
    highs = rows.groupBy(F.col("kafka_partition").cast("int").alias("kafka_partition")).agg(
        F.max("kafka_offset").cast("long").alias("high"))
    ran = spark.range(1).select(F.lit(None).cast("int").alias("kafka_partition"), F.lit(None).cast("long").alias("high"))
    marks = highs.where("kafka_partition IS NOT NULL").unionByName(ran).select(
        F.lit(topic).alias("kafka_topic"), "kafka_partition", F.lit(int(start_ms)).cast("long").alias("start_ms"),
        F.lit(int(stop_ms)).cast("long").alias("stop_ms"), "high")
    append_once(marks.coalesce(1), path, Run(f"marks {topic}", f"{start_ms}-{stop_ms}"))


def late_messages(spark: SparkSession, path: str, envelope: DataFrame) -> DataFrame:
    """Rows of ``envelope`` that are stamped inside a finished slice and were not there when it
    ran, with the slice's ``start_ms`` and ``stop_ms`` (one row for each such slice)."""
    marks = read_landing(spark, path, MARKS)
    slices = marks.where("kafka_partition IS NULL").select("kafka_topic", "start_ms", "stop_ms").distinct()
    slices = slices.withColumn("_step", F.explode(F.sequence(F.expr(f"start_ms div {STEP_MS}L"), F.expr(f"(stop_ms - 1) div {STEP_MS}L"))))
    env = envelope.withColumn("_step", F.expr(f"kafka_timestamp div {STEP_MS}L"))
    inside = env.join(slices, ["kafka_topic", "_step"]).where("kafka_timestamp >= start_ms AND kafka_timestamp < stop_ms")
    highs = marks.where("kafka_partition IS NOT NULL").groupBy("kafka_topic", "kafka_partition", "start_ms", "stop_ms").agg(F.max("high").alias("_high"))
    keys = ["kafka_topic", "kafka_partition", "start_ms", "stop_ms"]
    out = inside.join(highs, keys, "left").where("_high IS NULL OR kafka_offset > _high")
    return out.select(*[F.col(c) for c in envelope.columns], "start_ms", "stop_ms")


__all__ = ["mark_slice", "late_messages"]

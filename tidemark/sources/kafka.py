"""Bounded reads of message streams into the envelope shape.

``read_slice`` reads one closed time slice ``[start_ms, stop_ms)`` of a topic
with Spark's Kafka source (start inclusive, stop exclusive).  The Kafka
package must be on the classpath; it is not in the test image, so the tests
drive the same code with envelope DataFrames built from parquet tables.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.timez import ntz_to_unix_ms

if TYPE_CHECKING:  # for annotations only; sources do not depend on operators at run time
    from tidemark.operators.ingest import IngestSpec


def kafka_to_envelope(raw: DataFrame, message_type: str = "string") -> DataFrame:
    """Spark Kafka rows (value, topic, offset, timestamp, partition) as an envelope.

    The hash column is our own choice (SHA-256 of the payload bytes); the hash
    of the original consumer is not documented.
    """
    return raw.select(
        F.col("value").cast(message_type).alias("kafka_message"),
        F.col("topic").alias("kafka_topic"),
        F.col("offset").alias("kafka_offset"),
        F.unix_millis(F.col("timestamp")).alias("kafka_timestamp"),
        F.col("partition").alias("kafka_partition"),
        F.sha2(F.col("value").cast("binary"), 256).alias("kafka_hash"),
    )


def read_slice(spark: SparkSession, bootstrap_servers: str, topic: str, start_ms: int,
               stop_ms: int, message_type: str = "string",
               options: Mapping[str, str] | None = None) -> DataFrame:
    """Batch read of one topic between two timestamps, as an envelope."""
    r = (spark.read.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap_servers)
         .option("subscribe", topic)
         .option("startingTimestamp", str(int(start_ms)))
         .option("endingTimestamp", str(int(stop_ms))))
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return kafka_to_envelope(r.load(), message_type)


def read_stream(spark: SparkSession, bootstrap_servers: str, topic: str, start_ms: int | None = None,
                max_offsets_per_trigger: int | None = None, message_type: str = "string",
                options: Mapping[str, str] | None = None) -> DataFrame:
    """Streaming read of a topic as an envelope (``batch-size`` -> ``maxOffsetsPerTrigger``)."""
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap_servers)
         .option("subscribe", topic))
    if start_ms is not None:
        r = r.option("startingTimestamp", str(int(start_ms)))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", str(int(max_offsets_per_trigger)))
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return kafka_to_envelope(r.load(), message_type)


def slice_bounds(start: _dt.datetime, end: _dt.datetime) -> tuple[int, int]:
    """Epoch-ms bounds of a scheduler interval (``data_interval`` x 1000).

    Naive datetimes are taken as UTC.
    """
    def ms(t: _dt.datetime) -> int:
        if t.tzinfo is None:
            t = t.replace(tzinfo=_dt.timezone.utc)
        return int(t.timestamp() * 1000)
    return ms(start), ms(end)


def stream_for_spec(spark: SparkSession, spec: "IngestSpec", bootstrap_servers: str,
                    start_ms: int | None = None,
                    options: Mapping[str, str] | None = None) -> DataFrame:
    """Kafka stream of an ingest spec: its topic, ``batch-size`` as the per-trigger
    limit, and its payload type (text or binary)."""
    if not spec.topic:
        raise ValueError("the spec has no topic; fill it with IngestSpec.from_dict(..., topic=)")
    return read_stream(spark, bootstrap_servers, spec.topic, start_ms=start_ms,
                       max_offsets_per_trigger=spec.batch_size, message_type=spec.message_type,
                       options=options)


def slice_envelope(envelope: DataFrame, start_ms: int, stop_ms: int,
                   ts_col: str = "kafka_timestamp") -> DataFrame:
    """Rows of an envelope with ``start_ms <= timestamp < stop_ms``."""
    t = F.col(ts_col)
    return envelope.where((t >= F.lit(int(start_ms))) & (t < F.lit(int(stop_ms))))


def table_as_envelope(df: DataFrame, message: str, topic: str, offset: str, ts: str,
                      partition: str | None = None, n_partitions: int | None = None,
                      start_ms: int | None = None, stop_ms: int | None = None) -> DataFrame:
    """Present a table as an envelope (tests and replays from a landed table).

    ``ts`` is a UTC ``TIMESTAMP_NTZ``.  The slice bounds are applied to ``ts``
    itself, so they reach the parquet scan as pushed filters.  Without a
    partition column, ``partition`` may name a numeric column that is reduced
    modulo ``n_partitions``.
    """
    src = df
    if start_ms is not None:
        src = src.where(F.col(ts) >= F.timestamp_add("MILLISECOND", F.lit(int(start_ms)),
                                                      F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")))
    if stop_ms is not None:
        src = src.where(F.col(ts) < F.timestamp_add("MILLISECOND", F.lit(int(stop_ms)),
                                                     F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")))
    if partition is None:
        part = F.lit(0)
    elif n_partitions:
        part = F.pmod(F.col(partition), F.lit(n_partitions))
    else:
        part = F.col(partition)
    return src.select(
        F.col(message).alias("kafka_message"),
        F.col(topic).alias("kafka_topic"),
        F.col(offset).alias("kafka_offset"),
        ntz_to_unix_ms(ts).alias("kafka_timestamp"),
        part.cast("int").alias("kafka_partition"),
    )


__all__ = ["kafka_to_envelope", "read_slice", "read_stream", "slice_bounds", "slice_envelope",
           "stream_for_spec", "table_as_envelope"]

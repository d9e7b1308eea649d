"""Second stage after landing: payloads unpacked into typed rows, with a table of rejects.

The landing table's files are a stream of their own with its own checkpoint, so
either stage can stop and go on by itself.  A micro-batch is parsed once; its typed
and its rejected rows are appended to their tables under the query's id and number
(``operators.landing``), so each landed message is unpacked once, whatever fails
in between.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.operators.landing import Run, append_once, finish_appends
from tidemark.sources.tables import stream_table
from tidemark.streaming.ingest import finish, query_id

REASON, POSITION = "reason", "position"
_CORRUPT = "_corrupt"


@dataclasses.dataclass(frozen=True)
class UnpackSpec:
    """What a payload holds and which typed columns are made of it.

    ``schema``: the payload's fields (DDL).  ``columns``: typed column -> expression over
    the payload's fields, and over ``element`` if ``each`` names an array field, of
    which every element gives a row (``position`` from 0).  ``required``: typed columns
    without which a row is rejected.  ``keep``: columns of the landing table that typed
    and rejected rows carry.
    """

    schema: str
    columns: Mapping[str, str]
    required: Sequence[str] = ()
    each: str | None = None
    message: str = "melding"
    keep: Sequence[str] = ("kafka_topic", "kafka_partition", "kafka_offset")


def unpack(landing: DataFrame, spec: UnpackSpec) -> DataFrame:
    """Typed columns of each message with the ``reason`` for which it is rejected (NULL: it is not).

    Rejected are messages that are NULL or blank (``no message``), that are no JSON or hold
    a value of another type than declared (``does not fit the schema``), that lack the
    ``each`` field (``missing <field>``), and rows that lack a required column.  An empty
    array gives no row.  The payload is parsed once.
    """
    text = F.col(spec.message).cast("string")
    parsed = F.from_json(text, f"{spec.schema}, {_CORRUPT} string",
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    rows = landing.select(*spec.keep, text.alias("_message"), parsed.alias("_payload"))
    rows = rows.select(*spec.keep, "_message", "_payload.*")
    whole = (F.when(F.col("_message").isNull() | (F.trim("_message") == ""), F.lit("no message"))
             .when(F.col(_CORRUPT).isNotNull(), F.lit("does not fit the schema")))
    if spec.each:
        whole = whole.when(F.col(spec.each).isNull(), F.lit(f"missing {spec.each}"))
    rows = rows.withColumn("_whole", whole)
    if spec.each:
        # a rejected message stays as one row without elements
        elements = F.when(F.col("_whole").isNull(), F.transform(spec.each, lambda e, i: F.struct(i.alias("i"), e.alias("e"))))
        one = F.array(F.struct(F.lit(None).cast("int").alias("i"), F.get(F.col(spec.each), F.lit(0)).alias("e")))
        rows = rows.withColumn("_one", F.explode(F.coalesce(elements, one)))
        rows = rows.withColumn(POSITION, F.col("_one.i")).withColumn("element", F.col("_one.e"))
    position = [POSITION] if spec.each else []
    rows = rows.select(*spec.keep, *position, "_message", "_whole", *[F.expr(e).alias(c) for c, e in spec.columns.items()])
    reason = F.col("_whole")
    for c in spec.required:
        reason = F.coalesce(reason, F.when(F.col(c).isNull(), F.lit(f"missing {c}")))
    return rows.withColumn(REASON, reason).drop("_whole")


def typed_rows(unpacked: DataFrame) -> DataFrame:
    return unpacked.where(F.col(REASON).isNull()).drop(REASON, "_message")


def rejected_rows(unpacked: DataFrame, spec: UnpackSpec) -> DataFrame:
    """Rejected messages as they landed, with the reason."""
    position = [POSITION] if spec.each else []
    return unpacked.where(F.col(REASON).isNotNull()).select(
        *spec.keep, *position, F.col("_message").alias(spec.message), REASON)


def start_unpack(spark: SparkSession, landing_path: str, landing_schema: StructType, spec: UnpackSpec,
                 typed_path: str, rejected_path: str, checkpoint_path: str,
                 max_files_per_trigger: int = 1000, available_now: bool = True) -> StreamingQuery:
    """Start the second stage over the landing table's files."""
    finish_appends(spark, landing_path)
    stream = stream_table(spark, landing_path, landing_schema, max_files_per_trigger=max_files_per_trigger)

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        run = Run(query_id(batch.sparkSession, checkpoint_path), epoch_id)
        rows = unpack(batch, spec).persist()
        try:
            append_once(typed_rows(rows), typed_path, run)
            append_once(rejected_rows(rows, spec), rejected_path, run)
        finally:
            rows.unpersist()

    w = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint_path)
    return (w.trigger(availableNow=True) if available_now else w).start()


def run_unpack(*args, timeout_s: float | None = None, **kwargs) -> None:
    """Unpack what has landed and stop (the scheduled run)."""
    finish(start_unpack(*args, **kwargs), timeout_s)


__all__ = ["UnpackSpec", "unpack", "typed_rows", "rejected_rows", "start_unpack", "run_unpack"]

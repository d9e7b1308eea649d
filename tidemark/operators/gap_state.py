"""Offset gaps kept as a state: a check reads the batch, not the topic.

The state holds the *runs* of offsets seen in each stream, ``(stream, bucket, lo, hi)``:
every offset from ``lo`` to ``hi`` has come.  Runs end at bucket borders (fixed widths of
offsets), so a batch changes its own buckets only.  Sets of runs merge in any order and
any number of times, so late, repeated and re-read messages are no special case, and
the state's size follows the gaps, not the messages.

``update_gap_state`` makes a batch's runs, merges them with the state of the cells
(hashes of stream and bucket) that these fall into, and publishes the new cells as one
version (``sources.versions``).  ``state_gaps`` gives the gaps that ``offset_gaps`` finds in
all messages seen so far.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.gaps import BUCKETS_TOGETHER, DEFAULT_BUCKET_WIDTH
from tidemark.sources.versions import current, publish, read_version, write_cells

BUCKET, LO, HI, CELL = "bucket", "lo", "hi", "cell"
#: Parts of the state that are read and written as a whole.
CELLS = 64


def offset_runs(df: DataFrame, offset: str, by: Sequence[str], carry: str | None = None,
                bucket_width: int = DEFAULT_BUCKET_WIDTH) -> DataFrame:
    """Runs of the offsets in ``df``: ``by..., bucket, lo, hi`` (+ ``carry``: its largest value at ``hi``).

    Copies collapse map-side; a task takes a bucket of a stream, never a stream.
    Rows without an offset are left out."""
    keys = [*by, BUCKET]
    rows = df.where(F.col(offset).isNotNull()).select(
        *by, F.expr(f"`{offset}` div {int(bucket_width)}L").alias(BUCKET), F.col(offset).alias(LO),
        *([F.col(carry)] if carry else []))
    rows = rows.groupBy(*keys, LO).agg(*([F.max(carry).alias(carry)] if carry else [F.lit(1).alias("_")])).drop("_")
    return merge_runs(rows.withColumn(HI, F.col(LO)), by, carry)


def merge_runs(runs: DataFrame, by: Sequence[str], carry: str | None = None) -> DataFrame:
    """Runs that overlap or follow one another become one, within their bucket."""
    keys = [*by, BUCKET]
    w = Window.partitionBy(*keys).orderBy(LO, HI)
    before = F.max(HI).over(w.rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.withColumn("_new", F.when(F.col(LO) <= before + 1, 0).otherwise(1))
    runs = runs.withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    last = F.max(F.struct(HI, carry)).getField(carry).alias(carry) if carry else None
    return runs.groupBy(*keys, "_run").agg(F.min(LO).alias(LO), F.max(HI).alias(HI), *([last] if carry else [])).drop("_run")


def run_gaps(runs: DataFrame, by: Sequence[str], min_gap: int = 1, offset_floor: int | None = None,
             carry: str | None = None) -> DataFrame:
    """``by..., gap_from, gap_to, missing`` (+ ``carry``) between the runs, as ``offset_gaps`` gives them.

    Runs are linked within buckets, bucket edges within ranges of buckets, and what is
    left within streams."""
    extra = [carry] if carry else []
    own = runs.select(*by, BUCKET, LO, HI, *extra, F.lit(True).alias("_last"))

    def linked(level: DataFrame, *within: str) -> DataFrame:
        w = Window.partitionBy(*by, *within).orderBy(LO)
        return level.withColumn("_next", F.lead(LO).over(w)).withColumn("_first", F.lag(LO).over(w).isNull())

    def found(level: DataFrame) -> DataFrame:
        return level.where("_last AND _next IS NOT NULL").select(
            *by, F.col(HI).alias("gap_from"), F.col("_next").alias("gap_to"), *extra)

    def edges(level: DataFrame) -> DataFrame:
        return level.where("_next IS NULL OR _first").select(
            *by, BUCKET, LO, HI, *extra, (F.col("_last") & F.col("_next").isNull()).alias("_last"))

    inside = linked(own, BUCKET)
    between = linked(edges(inside).withColumn(BUCKET, F.expr(f"{BUCKET} div {BUCKETS_TOGETHER}L")), BUCKET)
    across = linked(edges(between))
    gaps = found(inside).unionByName(found(between)).unionByName(found(across))
    gaps = gaps.where(F.col("gap_to") - F.col("gap_from") > min_gap)
    if offset_floor is not None:
        gaps = gaps.where(F.col("gap_from") > offset_floor)
    return gaps.withColumn("missing", F.col("gap_to") - F.col("gap_from") - 1)


def _state_schema(batch: DataFrame, by: Sequence[str], carry: str | None) -> str:
    types = dict(batch.dtypes)
    fields = [*[(c, types[c]) for c in by], (BUCKET, "bigint"), (LO, "bigint"), (HI, "bigint")]
    return ", ".join(f"`{c}` {t}" for c, t in [*fields, *([(carry, types[carry])] if carry else [])])


def update_gap_state(spark: SparkSession, path: str, batch: DataFrame, offset: str, by: Sequence[str],
                     carry: str | None = None, bucket_width: int = DEFAULT_BUCKET_WIDTH) -> None:
    """Merge the batch's offsets into the state at ``path``.

    Read are the batch and the state's cells that it touches.  A batch may come again
    (a repeated run changes nothing); ``by``, ``carry`` and ``bucket_width`` stay the same
    for the state's life.  An empty batch makes no version.
    """
    by = list(by)
    schema = _state_schema(batch, by, carry)
    cell = F.format_string("c%02d", F.pmod(F.xxhash64(*by, BUCKET), F.lit(CELLS)))
    new = offset_runs(batch.select(*by, F.col(offset).cast("bigint").alias(offset), *([carry] if carry else [])),
                      offset, by, carry, bucket_width).withColumn(CELL, cell).persist()
    try:
        touched = sorted(r[CELL] for r in new.select(CELL).distinct().collect())  # at most CELLS
        if not touched:
            return
        old = current(spark, path)
        known = read_version(spark, path, schema, touched, old)
        merged = merge_runs(new.drop(CELL).unionByName(known), by, carry).withColumn(CELL, cell)
        publish(spark, path, old, {**old.cells, **write_cells(merged, path, CELL)})
    finally:
        new.unpersist()


def state_gaps(spark: SparkSession, path: str, like: DataFrame, by: Sequence[str], min_gap: int = 1,
               offset_floor: int | None = None, carry: str | None = None) -> DataFrame:
    """Gaps of all messages that the state has seen; ``like`` gives the types of ``by`` and ``carry``."""
    runs = read_version(spark, path, _state_schema(like, list(by), carry))
    return run_gaps(runs, list(by), min_gap, offset_floor, carry)


__all__ = ["offset_runs", "merge_runs", "run_gaps", "update_gap_state", "state_gaps"]

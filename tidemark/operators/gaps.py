"""Offset-gap detection over landing tables (consumer completeness checks).

A landing table holds one row per consumed message with the message's
``offset`` inside its stream (topic, or topic and partition).  A *gap* is a
pair of consecutive distinct offsets ``(gap_from, gap_to)`` in one stream with
``gap_to - gap_from > min_gap``; ``missing = gap_to - gap_from - 1`` offsets lie
between them.

Counting gaps is ``LEAD(offset) OVER (PARTITION BY stream ORDER BY offset)``
followed by a filter.  That plan puts a whole stream in one task, so a hot
topic holding a third of all rows becomes one giant sort.  ``offset_gaps``
computes the same pairs with the work split into fixed-width offset buckets:

1. collapse duplicate offsets with a map-side partial aggregate on
   (stream, bucket, offset), so a message landed many times - even one copy
   group holding a third of all rows - costs one row per map task in the
   shuffle;
2. take LEAD and LAG inside each (stream, bucket); a bucket holds at most
   ``bucket_width`` distinct offsets, so no window partition can grow with the
   row count, and a hot stream spreads over all of its buckets;
3. the rows without a neighbour on one side are the buckets' edges, at most two
   per bucket; the same step over buckets of buckets links them, and once more
   over each stream what is left.

The input is read once: pairs and edges come from the same window, and the plan
reuses its exchange.

Duplicated offsets never form a gap (difference 0), so collapsing them keeps
the count whenever the final filter only looks at the offset.  When a filter on
another column is applied *after* LEAD (``carry``), the copy that carries the
real successor is the last one in ``ORDER BY offset, carry``, i.e. the one with
the largest ``carry``; ``offset_gaps`` keeps ``max(carry)`` for that reason.
This makes the result deterministic where the plain LEAD form is not (ties).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BUCKET_WIDTH = 1 << 20
#: Buckets whose edges are linked together before the streams' last step.
BUCKETS_TOGETHER = 1 << 16


def _cols(by: str | Sequence[str] | None) -> list[str]:
    if by is None:
        return []
    if isinstance(by, str):
        return [by]
    return list(by)


def offset_gaps(df: DataFrame, offset: str, by: str | Sequence[str] | None = None, *,
                min_gap: int = 1, offset_floor: int | None = None,
                carry: str | None = None,
                bucket_width: int = DEFAULT_BUCKET_WIDTH,
                collapse_copies: bool = True) -> DataFrame:
    """All gaps larger than ``min_gap`` between consecutive distinct offsets.

    Returns ``by..., gap_from, gap_to, missing`` (+ ``carry`` = max of the
    carried column over the rows at ``gap_from``).

    ``bucket_width``: offsets of a bucket; the result does not depend on it.

    ``collapse_copies`` (default) removes repeated offsets with a map-side
    partial aggregate before the window shuffle, so a group of copies holding a
    large share of the rows cannot overload one task.  ``False`` skips that
    step - one full shuffle instead of two - for tables known to hold few
    copies (e.g. a deduplicated landing table checked per topic and
    partition).  The result is the same either way: a repeated offset meets
    itself (difference 0) and only its last copy carries the successor.

    ``offset_floor``: only gaps whose ``gap_from`` is above this value.  LEAD
    looks forward, so rows at or below the floor cannot change a gap above it;
    the filter is therefore applied before the shuffle and reaches the scan.
    Any filter meant to be applied *before* LEAD should be applied to ``df`` by
    the caller; a filter meant for *after* LEAD goes on the result (``carry``).
    """
    keys = _cols(by)
    off = F.col(offset)
    src = df.where(off.isNotNull())
    if offset_floor is not None:
        src = src.where(off > F.lit(offset_floor))
    if bucket_width < 1:
        raise ValueError("bucket_width must be positive")
    extra = [carry] if carry else []
    rows = src.select(*keys, offset, *extra, F.expr(f"`{offset}` div {int(bucket_width)}L").alias("_bucket"))
    if collapse_copies and carry:
        rows = rows.groupBy(*keys, "_bucket", offset).agg(F.max(carry).alias(carry))
    elif collapse_copies:
        rows = rows.select(*keys, "_bucket", offset).distinct()

    order = [F.col(offset), *([F.col(carry)] if carry else [])]

    def linked(edges: DataFrame, *within: str) -> DataFrame:
        w = Window.partitionBy(*keys, *within).orderBy(*order)
        return edges.withColumn("_next", F.lead(offset).over(w)).withColumn("_first", F.lag(offset).over(w).isNull())

    def found(level: DataFrame) -> DataFrame:
        return level.where("_last AND _next IS NOT NULL").select(
            *keys, F.col(offset).alias("gap_from"), F.col("_next").alias("gap_to"), *extra)

    def edges_of(level: DataFrame) -> DataFrame:
        # a row that is no bucket's last has its successor inside that bucket
        return level.where("_next IS NULL OR _first").select(
            *keys, "_bucket", offset, *extra, (F.col("_last") & F.col("_next").isNull()).alias("_last"))

    inside = linked(rows.withColumn("_last", F.lit(True)), "_bucket")
    between = linked(edges_of(inside).withColumn("_bucket", F.expr(f"_bucket div {BUCKETS_TOGETHER}L")), "_bucket")
    across = linked(edges_of(between))
    pairs = found(inside).unionByName(found(between)).unionByName(found(across))
    return (pairs.where((F.col("gap_to") - F.col("gap_from")) > F.lit(min_gap))
            .withColumn("missing", F.col("gap_to") - F.col("gap_from") - 1))


def offset_gaps_lead(df: DataFrame, offset: str, by: str | Sequence[str] | None = None, *,
                     min_gap: int = 1, offset_floor: int | None = None,
                     carry: str | None = None) -> DataFrame:
    """The same pairs with one LEAD over each whole stream (reference form).

    Kept as the brute-force form for tests and for small tables; it places a
    whole stream in one task.
    """
    keys = _cols(by)
    order = [F.col(offset)] + ([F.col(carry)] if carry else [])
    w = Window.partitionBy(*keys).orderBy(*order)
    out = df.select(*keys, offset, *([carry] if carry else [])).withColumn(
        "_next", F.lead(offset).over(w))
    cond = (F.col("_next") - F.col(offset)) > F.lit(min_gap)
    if offset_floor is not None:
        cond = cond & (F.col(offset) > F.lit(offset_floor))
    return (out.where(cond)
            .select(*keys, F.col(offset).alias("gap_from"), F.col("_next").alias("gap_to"),
                    *([F.col(carry)] if carry else []))
            .withColumn("missing", F.col("gap_to") - F.col("gap_from") - 1))


def gap_count(df: DataFrame, offset: str, by: str | Sequence[str] | None = None, *,
              min_gap: int = 1, offset_floor: int | None = None,
              after: Column | None = None, carry: str | None = None,
              name: str = "gap_count", bucket_width: int = DEFAULT_BUCKET_WIDTH,
              collapse_copies: bool = True) -> DataFrame:
    """One row ``name`` = number of gaps; ``after`` filters gap rows after LEAD.

    ``after`` may refer to ``carry`` (e.g. ``F.col("loaded") > date``).
    """
    gaps = offset_gaps(df, offset, by, min_gap=min_gap, offset_floor=offset_floor,
                       carry=carry, bucket_width=bucket_width, collapse_copies=collapse_copies)
    if after is not None:
        gaps = gaps.where(after)
    return gaps.agg(F.count(F.lit(1)).alias(name))


__all__ = ["offset_gaps", "offset_gaps_lead", "gap_count", "DEFAULT_BUCKET_WIDTH"]

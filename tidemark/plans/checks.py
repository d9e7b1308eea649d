"""Several checks of one table in one scan.

A row is tagged with the checks that it belongs to; copies are collapsed with their
tags, and then each tag is a row of its own.  What a check looks up joins the tagged
rows once for all checks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.gaps import DEFAULT_BUCKET_WIDTH, offset_gaps

TAG, KEY, AT, COUNT = "tag", "key", "at", "n"


class GapCheck(NamedTuple):
    """A gap count: ``where`` filters before LEAD, ``after`` the gaps (by the carried column)."""

    where: Column | None = None
    offset_floor: int | None = None
    after: Column | None = None
    min_gap: int = 1


def gap_counts(df: DataFrame, offset: str, by: Sequence[str], checks: Mapping[str, GapCheck],
               carry: str | None = None, bucket_width: int = DEFAULT_BUCKET_WIDTH) -> DataFrame:
    """One row with the gaps of every check, from one scan of ``df``.

    Rows collapse to (stream, offset, checks) map-side before the checks are told
    apart, so copies cost nothing; the windows then run by check, stream and bucket."""
    def inside(c: GapCheck) -> Column:
        conds = [c.where] if c.where is not None else []
        conds += [F.col(offset) > c.offset_floor] if c.offset_floor is not None else []
        return F.coalesce(reduce(lambda a, b: a & b, conds, F.lit(True)), F.lit(False))

    masks = [F.when(inside(c), F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(checks.values())]
    rows = df.where(F.col(offset).isNotNull()).where(reduce(lambda a, b: a | b, map(inside, checks.values())))
    rows = rows.select(*by, offset, *([carry] if carry else []), reduce(lambda a, b: a + b, masks).alias("_mask"))
    rows = rows.groupBy(*by, offset, "_mask").agg(*([F.max(carry).alias(carry)] if carry else [F.lit(1).alias("_")])).drop("_")
    own = F.filter(F.array(*[F.lit(i) for i in range(len(checks))]), lambda i: F.getbit("_mask", i) == 1)
    rows = rows.select(*by, offset, *([carry] if carry else []), F.explode(own).alias("_check"))
    gaps = offset_gaps(rows, offset, ["_check", *by], carry=carry, bucket_width=bucket_width, collapse_copies=False)

    def counted(i: int, c: GapCheck) -> Column:
        cond = (F.col("_check") == i) & (F.col("gap_to") - F.col("gap_from") > c.min_gap)
        return F.count_if(cond & c.after if c.after is not None else cond)

    return gaps.agg(*[counted(i, c).alias(name) for i, (name, c) in enumerate(checks.items())])


class Tagged(NamedTuple):
    """Rows of a check: those that ``where`` lets in, with their key and a second column."""

    key: Column
    at: Column | None = None
    where: Column | None = None


def tagged_rows(df: DataFrame, parts: Mapping[str, Tagged], at_type: str, key_type: str = "bigint") -> DataFrame:
    """``tag, key, at, n``: the rows of every part in one scan, counted by tag, key and at."""
    def row(tag: str, p: Tagged) -> Column:
        at = p.at if p.at is not None else F.lit(None)
        one = F.struct(F.lit(tag).alias(TAG), p.key.cast(key_type).alias(KEY), at.cast(at_type).alias(AT))
        return F.when(p.where, one) if p.where is not None else one

    rows = F.array(*[row(t, p) for t, p in parts.items()])
    if all(p.where is not None for p in parts.values()):
        df = df.where(reduce(lambda a, b: a | b, (p.where for p in parts.values())))
    rows = df.select(F.explode(rows).alias("_r")).where(F.col("_r").isNotNull()).select("_r.*")
    return rows.groupBy(TAG, KEY, AT).agg(F.count("*").alias(COUNT))


def person_counts(facts: DataFrame, dims: DataFrame, validity: Sequence[str], unmatched: Sequence[str]) -> DataFrame:
    """One row: for the tags in ``validity`` the joined rows of facts and intervals (``dims`` rows
    with ``lo``, ``hi``) around the fact's day; for those in ``unmatched`` the facts whose
    key is in no ``dims`` row without bounds (a case).  One join for all tags.

    ``facts``: ``tagged_rows`` with days; ``dims``: ``person, lo, hi``.
    """
    f, d = facts.alias("f"), dims.alias("d")
    is_case = F.col("d.lo").isNull()
    met = F.when(F.col("f.tag").isin(*unmatched), is_case).otherwise(~is_case & F.col("f.at").between(F.col("d.lo"), F.col("d.hi")))
    j = f.join(d, (F.col("f.key") == F.col("d.person")) & met, "left")
    found = F.col("d.person").isNotNull()

    def total(tag: str, cond: Column) -> Column:
        return F.coalesce(F.sum(F.when((F.col("f.tag") == tag) & cond, F.col("f.n"))), F.lit(0)).alias(tag)

    return j.agg(*[total(t, found) for t in validity], *[total(t, ~found) for t in unmatched])


def domain_counts(left: DataFrame, right: DataFrame, new_right: Mapping[str, str], new_left: Mapping[str, str],
                  not_in: Mapping[str, str], changed: Mapping[str, str]) -> DataFrame:
    """One row of counts over one full outer join of two ``tagged_rows`` by tag and key.

    Each mapping is name -> tag.  ``new_right`` / ``new_left``: distinct values of that side
    without an equal one on the other (NULL is new).  ``not_in``: the right values ``NOT IN``
    the left ones, by three-valued logic.  ``changed``: joined rows whose ``at`` differ.
    """
    x, y = left.alias("x"), right.alias("y")
    j = x.join(y, (F.col("x.tag") == F.col("y.tag")) & (F.col("x.key") == F.col("y.key")), "full_outer")

    def on_left(tag: str) -> Column:
        return F.coalesce(F.col("x.tag") == tag, F.lit(False))

    def on_right(tag: str) -> Column:
        return F.coalesce(F.col("y.tag") == tag, F.lit(False))

    out = [F.count_if(on_right(t) & F.col("x.tag").isNull()).alias(n) for n, t in new_right.items()]
    out += [F.count_if(on_left(t) & F.col("y.tag").isNull()).alias(n) for n, t in new_left.items()]
    for n, t in not_in.items():
        outside = F.count_if(on_right(t) & F.col("x.tag").isNull() & F.col("y.key").isNotNull())
        out.append(F.when(F.count_if(on_left(t)) == 0, F.count_if(on_right(t)))
                   .when(F.count_if(on_left(t) & F.col("x.key").isNull()) > 0, F.lit(0)).otherwise(outside).alias(n))
    for n, t in changed.items():
        pairs = F.when(on_left(t) & on_right(t) & (F.col("x.at") != F.col("y.at")), F.col("x.n") * F.col("y.n"))
        out.append(F.coalesce(F.sum(pairs), F.lit(0)).alias(n))
    return j.agg(*out)


__all__ = ["GapCheck", "gap_counts", "Tagged", "tagged_rows", "person_counts", "domain_counts"]

"""Wide-table unpivot, distinct counts by code, and reconciliation of aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def unpivot_nonnull(df: DataFrame, ids: Sequence[str], values: Mapping[str, str],
                    label: str = "code", value: str = "amount") -> DataFrame:
    """``UNPIVOT (value FOR label IN (col AS 'LABEL', ...))`` with NULL cells dropped.

    ``DataFrame.unpivot`` keeps NULL cells, SQL ``UNPIVOT`` drops them; this
    follows SQL.  ``values`` maps the output label to the source column.
    """
    staged = df.select(*ids, *[F.col(c).alias(lab) for lab, c in values.items()])
    return (staged.unpivot(list(ids), list(values), label, value)
            .where(F.col(value).isNotNull()))


def distinct_by_code(df: DataFrame, ids: Sequence[str], values: Mapping[str, str], entity: str,
                     label: str = "code", name: str = "n_distinct") -> DataFrame:
    """``count(distinct case when value is not null then entity end)`` per ids + label,
    over the unpivoted table (NULL cells dropped).

    Equivalent plan without multiplying the rows first: collapse to one row per
    (ids, entity) with a has-value flag per column (map-side partial aggregate,
    so the shuffle carries at most one row per entity and group), unpivot those
    flags and count entities.  A group appears for a label exactly when some row
    of it has a value there, as with ``UNPIVOT``; NULL entities are not counted.
    """
    flags = [F.max(F.col(c).isNotNull()).alias(lab) for lab, c in values.items()]
    per_entity = df.groupBy(*ids, entity).agg(*flags)
    long = (per_entity.unpivot([*ids, entity], list(values), label, "_has")
            .where(F.col("_has")))
    return long.groupBy(*ids, label).agg(F.count(entity).alias(name))


def reconcile(left: DataFrame, right: DataFrame, keys: Sequence[str], left_value: str,
              right_value: str, right_name: str | None = None, diff: str = "diff",
              report_missing: bool = False) -> DataFrame:
    """Left join of two aggregates on ``keys``; keep rows with ``left - right > 0``.

    A key absent on the right gives a NULL difference and is dropped, as in SQL;
    ``report_missing=True`` keeps those rows too.  ``left`` may carry more
    grouping columns than ``keys``; several left rows then meet one right row.
    """
    rname = right_name or f"{right_value}_right"
    r = right.select(*keys, F.col(right_value).alias(rname))
    j = left.join(r, list(keys), "left").withColumn(diff, F.col(left_value) - F.col(rname))
    cond = F.col(diff) > 0
    if report_missing:
        cond = cond | F.col(diff).isNull()
    return j.where(cond)


def reconcile_subset(rows: DataFrame, keys: Sequence[str], extra: Sequence[str], entity: str, subset: str,
                     name: str = "n_distinct", right_name: str | None = None, diff: str = "diff") -> DataFrame:
    """Distinct entities per ``keys`` and ``extra`` against those of the ``subset`` rows per ``keys``.

    The same rows as ``reconcile`` of the two counts, in one pass over ``rows``: a row stands
    for itself and, if the flag ``subset`` holds, for the compared count; both are counted in
    one aggregate, and a window over the (few) counts of a key brings them together.
    Only differences above 0 are kept; keys without a compared count are dropped.
    """
    right = right_name or f"{name}_right"
    once = rows.groupBy(*keys, *extra, entity).agg(F.max(subset).alias("_in"))
    own = F.struct(*[F.col(c) for c in extra], F.lit(False).alias("_right"))
    other = F.struct(*[F.lit(None).cast(t).alias(c) for c, t in once.select(*extra).dtypes], F.lit(True).alias("_right"))
    both = once.select(*keys, entity, F.explode(F.when(F.col("_in"), F.array(own, other)).otherwise(F.array(own))).alias("_of"))
    counts = both.groupBy(*keys, "_of").agg(F.count_distinct(entity).alias(name)).select(*keys, "_of.*", name)
    compared = F.max(F.when(F.col("_right"), F.col(name))).over(Window.partitionBy(*keys))
    out = counts.withColumn(right, compared).where("NOT _right").drop("_right")
    out = out.withColumn(diff, F.col(name) - F.col(right)).where(F.col(diff) > 0)
    return out.where(reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys)))


__all__ = ["reconcile_subset", "unpivot_nonnull", "distinct_by_code", "reconcile"]

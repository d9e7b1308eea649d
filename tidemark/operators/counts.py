"""Counts over rolling and calendar windows, many metrics in one pass."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timez import days_before, midnight_days_before


def rolling_bound(ts: str, as_of: _dt.datetime | str, days: int, inclusive: bool = True) -> Column:
    """``ts >= as_of - n days`` (or ``>`` when ``inclusive`` is False)."""
    lo = days_before(as_of, days)
    return (F.col(ts) >= lo) if inclusive else (F.col(ts) > lo)


def calendar_bound(ts: str, as_of: _dt.datetime | str, days: int) -> Column:
    """``trunc(ts,'dd') >= trunc(as_of,'dd') - n`` written as ``ts >= midnight``.

    Same rows, but a bare column compare, which reaches the parquet scan.
    """
    return F.col(ts) >= midnight_days_before(as_of, days)


def count_metrics(df: DataFrame, metrics: Mapping[str, Column | None],
                  where: Column | None = None) -> DataFrame:
    """One row with one count per metric, in a single scan.

    ``metrics`` maps an output name to a condition (``None`` = all rows after
    ``where``).  ``where`` should be the loosest common bound, so it is pushed
    into the scan while each metric narrows it with ``count_if``.
    """
    src = df.where(where) if where is not None else df
    aggs = []
    for name, cond in metrics.items():
        aggs.append((F.count(F.lit(1)) if cond is None else F.count_if(cond)).alias(name))
    return src.agg(*aggs)


def recent_counts(df: DataFrame, ts: str, as_of: _dt.datetime | str,
                  windows: Mapping[str, tuple[int, bool]]) -> DataFrame:
    """Counts of rows in several rolling windows ``name -> (days, inclusive)``."""
    widest = max(d for d, _ in windows.values())
    metrics = {name: rolling_bound(ts, as_of, d, inc) for name, (d, inc) in windows.items()}
    return count_metrics(df, metrics, where=rolling_bound(ts, as_of, widest, True))


def typed_counts(df: DataFrame, ts: str, as_of: _dt.datetime | str, days: int, type_col: str,
                 types: Mapping[str, str], total: str = "total") -> DataFrame:
    """Total plus one count per type value, one pass instead of one scan per count."""
    metrics: dict[str, Column | None] = {total: None}
    for name, value in types.items():
        metrics[name] = F.col(type_col) == F.lit(value)
    return count_metrics(df, metrics, where=rolling_bound(ts, as_of, days, True))


def recent_distinct(df: DataFrame, ts: str, as_of: _dt.datetime | str, days: int, col: str,
                    name: str = "n_distinct") -> DataFrame:
    """Exact ``COUNT(DISTINCT col)`` over a rolling window."""
    return df.where(rolling_bound(ts, as_of, days)).agg(F.count_distinct(col).alias(name))


__all__ = ["rolling_bound", "calendar_bound", "count_metrics", "recent_counts", "typed_counts",
           "recent_distinct"]

"""Exact distinct counts that merge: bit maps of ids for each day.

A count of distinct ids over a week cannot be made of seven daily counts, but of seven
daily sets.  A set of integer ids is kept as Spark's bit maps (``part`` = the range of
32,768 ids, ``map`` = a bit for each), built and united by Spark's own aggregates, map-side
first.  The state is kept in versions with a cell for each day, so a daily run reads the
day's rows and a report reads the days it covers.  Uniting is free of order and of
repeats: late rows change their day's cell, and a batch may come again.

A condition on the value (``count(distinct CASE WHEN v IS NOT NULL THEN id END)``) is a filter
on the rows, with the code as one of ``by``.  Ids are long integers; rows without an id or a
day count nothing.  Ids far apart cost a map each (4 KB of which Parquet keeps a few
dozen bytes).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.versions import current, publish, read_version, write_cells

DAY, PART, MAP, CELL = "day", "part", "map", "cell"


def daily_sets(df: DataFrame, day: str, id_col: str, by: Sequence[str] = ()) -> DataFrame:
    """``by..., day, part, map``: the ids of each day as bit maps."""
    rows = df.where(F.col(id_col).isNotNull() & F.col(day).isNotNull())
    own = F.col(id_col).cast("long")
    return (rows.groupBy(*by, F.col(day).cast("date").alias(DAY), F.bitmap_bucket_number(own).alias(PART))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(own)).alias(MAP)))


def count_sets(sets: DataFrame, by: Sequence[str] = (), name: str = "n_distinct") -> DataFrame:
    """Distinct ids of all the days in ``sets``, by ``by`` (no row gives 0 without ``by``)."""
    united = sets.groupBy(*by, PART).agg(F.bitmap_or_agg(MAP).alias(MAP))
    return united.groupBy(*by).agg(F.coalesce(F.sum(F.bitmap_count(MAP)), F.lit(0)).alias(name))


def _schema(df: DataFrame, by: Sequence[str]) -> str:
    types = dict(df.dtypes)
    return ", ".join([*(f"`{c}` {types[c]}" for c in by), f"{DAY} date", f"{PART} bigint", f"{MAP} binary"])


def update_distinct_state(spark: SparkSession, path: str, batch: DataFrame, day: str, id_col: str,
                          by: Sequence[str] = ()) -> None:
    """Unite the batch's daily sets with the state at ``path``; only the batch's days are read."""
    new = daily_sets(batch, day, id_col, by).persist()
    try:
        days = sorted(r[DAY].isoformat() for r in new.select(DAY).distinct().collect())
        if not days:
            return
        old = current(spark, path)
        known = read_version(spark, path, _schema(batch, by), days, old)
        united = new.unionByName(known).groupBy(*by, DAY, PART).agg(F.bitmap_or_agg(MAP).alias(MAP))
        cells = write_cells(united.withColumn(CELL, F.col(DAY).cast("string")), path, CELL)
        publish(spark, path, old, {**old.cells, **cells})
    finally:
        new.unpersist()


def distinct_between(spark: SparkSession, path: str, like: DataFrame, first: _dt.date, last: _dt.date,
                     by: Sequence[str] = (), name: str = "n_distinct") -> DataFrame:
    """Exact distinct ids from day ``first`` to day ``last``, both included."""
    version = current(spark, path)
    days = [d for d in version.cells if first.isoformat() <= d <= last.isoformat()]
    return count_sets(read_version(spark, path, _schema(like, by), days, version), by, name)


__all__ = ["daily_sets", "count_sets", "update_distinct_state", "distinct_between"]

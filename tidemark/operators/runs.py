"""Run-history counts (successful runs per job in a half-open time window)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timez import ts_literal


def run_success_counts(runs: DataFrame, id_col: str, state_col: str, time_col: str,
                       start: _dt.datetime | str, end: _dt.datetime | str,
                       state: str = "success", name: str = "success_count") -> DataFrame:
    """Runs in ``state`` with ``start <= time < end``, counted per job id."""
    t = F.col(time_col)
    return (runs.where((F.col(state_col) == F.lit(state)) & (t >= ts_literal(start))
                       & (t < ts_literal(end)))
            .groupBy(F.col(id_col).alias("dag_id"))
            .agg(F.count(F.lit(1)).alias(name)))


def run_success_report(counts: DataFrame, name: str = "success_count") -> DataFrame:
    """One text row: ``DAG ID: <id>, Success Count: <n>`` lines, ordered by id.

    The input has one row per job id, so the text has a bounded number of lines.
    """
    # fixed value: the report line that the job's readers know
    line = F.concat(F.lit("DAG ID: "), F.col("dag_id").cast("string"), F.lit(", Success Count: "),
                    F.col(name).cast("string"))
    return counts.select(line.alias("_l"), F.col("dag_id")).agg(
        F.expr("listagg(_l, '\\n') WITHIN GROUP (ORDER BY dag_id)").alias("report"))


__all__ = ["run_success_counts", "run_success_report"]

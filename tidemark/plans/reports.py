"""Report plans: many metrics in one job, report lines, alerts.

The warehouse jobs ran each count as its own round trip and formatted the
results in Python.  Here a report is one DataFrame of ``(pos, metric, value)``
rows; Catalyst plans every branch in one job.  Texts are built with SQL string
functions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import REPORT_WIDTH, dot_line
from tidemark.operators.reconcile import distinct_by_code, reconcile


def metric_rows(row: DataFrame, order: Sequence[str] | None = None, after: int = 0) -> DataFrame:
    """A one-row DataFrame of named counts as ``(pos, metric, value)`` rows; positions follow ``after``."""
    cols = list(order) if order else row.columns
    items = [F.struct(F.lit(after + i + 1).alias("pos"), F.lit(c).alias("metric"),
                      F.col(f"`{c}`").cast("bigint").alias("value")) for i, c in enumerate(cols)]
    return row.select(F.inline(F.array(*items)))


def union_metrics(frames: Mapping[str, DataFrame]) -> DataFrame:
    """``name -> one-row DataFrame`` (first column is the value) as metric rows."""
    out = None
    for i, (name, df) in enumerate(frames.items()):
        part = df.select(F.lit(i + 1).alias("pos"), F.lit(name).alias("metric"),
                         F.col(df.columns[0]).cast("bigint").alias("value"))
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no metrics")
    return out


def report_lines(metrics: DataFrame, labels: Mapping[str, str],
                 width: int = REPORT_WIDTH) -> DataFrame:
    """``(pos, metric, line)``: ``label.......value`` for each metric row."""
    label = F.lit(None).cast("string")
    for m, text in labels.items():
        label = F.when(F.col("metric") == m, F.lit(text)).otherwise(label)
    return metrics.select("pos", "metric",
                          dot_line(F.coalesce(label, F.col("metric")), F.col("value"), width).alias("line"))


def joined_lines(row: DataFrame, lines: Mapping[str, tuple[str, Sequence[str]]], after: int = 0,
                 width: int = REPORT_WIDTH) -> DataFrame:
    """``(pos, metric, line)`` with several counts on one line: ``label.......a/b/c``.

    ``row`` is a one-row DataFrame of named counts, ``lines`` maps a metric to its
    label and columns; positions follow ``after``.
    """
    items = [F.struct(F.lit(after + i + 1).alias("pos"), F.lit(name).alias("metric"), dot_line(
        F.lit(label), F.concat_ws("/", *[F.col(c).cast("string") for c in cols]), width).alias("line"))
        for i, (name, (label, cols)) in enumerate(lines.items())]
    return row.select(F.inline(F.array(*items)))


def code_lists(lists: Mapping[str, DataFrame]) -> DataFrame:
    """``(metric, code)``: every code of every list (first column), whatever their number.

    Rows, not arrays: a list of new codes has no bound, and a cell has.
    """
    out = None
    for name, df in lists.items():
        part = df.select(F.lit(name).alias("metric"), F.col(df.columns[0]).cast("string").alias("code"))
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no lists")
    return out


def report_text(lines: DataFrame, header: str | None = None) -> DataFrame:
    """One row ``text``: the report lines in ``pos`` order, joined by newlines,
    under an optional header.  The input has one row per metric, so the text is
    bounded by the number of metrics."""
    body = F.expr("listagg(line, '\\n') WITHIN GROUP (ORDER BY pos)")
    text = F.concat(F.lit(header + "\n"), body) if header else body
    return lines.agg(text.alias("text"))


# Fixed texts of the gap alert (ours, in English).
NO_GAPS_TEXT = "No gaps found in any topic."
GAPS_PREFIX = "Gaps found in: "
GAPS_SUFFIX = ". Check the offsets by hand to find them."


def gap_alert(gap_counts: Mapping[str, DataFrame] | DataFrame) -> DataFrame:
    """One row ``alert``: the names with a gap count above 0, or the all-clear text.

    ``gap_counts``: metric rows, or a one-row DataFrame for each name."""
    rows = gap_counts if isinstance(gap_counts, DataFrame) else union_metrics(gap_counts)
    rows = rows.where(F.col("value") > 0)
    names = F.expr("listagg(metric, ', ') WITHIN GROUP (ORDER BY metric)")
    return rows.agg(
        F.when(F.count(F.lit(1)) == 0, F.lit(NO_GAPS_TEXT))
        .otherwise(F.concat(F.lit(GAPS_PREFIX), names, F.lit(GAPS_SUFFIX))).alias("alert"))


def monthly_reconciliation(wide: DataFrame, wide_ids: Sequence[str], values: Mapping[str, str],
                           entity: str, fact_counts: DataFrame, keys: Sequence[str],
                           count_col: str = "n_distinct", code: str = "code",
                           period_col: str = "periode", period: str | None = None,
                           report_missing: bool = False) -> DataFrame:
    """Distinct entities per code in a wide table against the same count from facts.

    ``wide``: one column per code (NULL = no amount); counted with
    ``distinct_by_code`` after an unpivot that drops NULL cells.  ``fact_counts``
    already holds the fact side, one row per ``keys`` (+ extra columns), with
    ``count_col``.  Rows whose fact count exceeds the wide-table count are kept;
    ``period`` restricts the result to one period (the comparison value is an
    argument, not a literal in the query).
    """
    wide_counts = distinct_by_code(wide, wide_ids, values, entity, label=code, name=count_col)
    out = reconcile(fact_counts, wide_counts, keys, count_col, count_col,
                    right_name=f"{count_col}_wide", diff=f"diff_{count_col}",
                    report_missing=report_missing)
    if period is not None:
        out = out.where(F.col(period_col) == F.lit(period))
    return out


__all__ = ["joined_lines", "code_lists", "monthly_reconciliation", "report_text", "metric_rows", "union_metrics", "report_lines",
           "gap_alert", "NO_GAPS_TEXT", "GAPS_PREFIX", "GAPS_SUFFIX"]

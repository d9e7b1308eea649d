"""Report text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

REPORT_WIDTH = 60


def dot_line(label: str | Column, value: str | Column, width: int = REPORT_WIDTH) -> Column:
    """``label.......value``: label filled up with dots to ``width`` characters; a
    longer label stays whole."""
    lab = F.col(label) if isinstance(label, str) else label
    val = F.col(value) if isinstance(value, str) else value
    dots = F.repeat(F.lit("."), F.greatest(F.lit(width) - F.length(lab), F.lit(0)))
    return F.concat(lab, dots, val.cast("string"))


__all__ = ["dot_line", "REPORT_WIDTH"]

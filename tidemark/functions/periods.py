"""Reporting-period arithmetic as column expressions.

The scheduler jobs compute these once for "today".  Here they take a date
column, so they run over any table and can be checked for every date.
Months are ``yyyyMM`` text, days ``yyyyMMdd`` text.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_text(d: str | Column, months: int = 0) -> Column:
    """``yyyyMM`` of ``d`` shifted by ``months`` (end-of-month clamped)."""
    x = F.to_date(_as_col(d))
    if months:
        x = F.add_months(x, months)
    return F.date_format(x, "yyyyMM")


def prev_period(d: str | Column) -> Column:
    """Month before ``d`` (the day before the 1st), ``yyyyMM``."""
    return month_text(d, -1)


def prev_month_end(d: str | Column) -> Column:
    """Last day of the month before ``d``, ``yyyyMMdd``."""
    return F.date_format(F.last_day(F.add_months(F.to_date(_as_col(d)), -1)), "yyyyMMdd")


# Run type by run date (day 1 of the month).
#   January 1 -> "A" (yearly), April 1 -> "K" (quarterly),
#   July 1 -> "H" (half-yearly), October 1 -> "S".
# Look-back in months for the first period of each type:
#   A 12, S 9, H 6, K 3.
PERIOD_TYPE_BY_MONTH = {1: "A", 4: "K", 7: "H", 10: "S"}
LOOKBACK_MONTHS = {"A": 12, "S": 9, "H": 6, "K": 3}


def period_type(d: str | Column) -> Column:
    """Run type of a date: A/K/H/S on 1 Jan/Apr/Jul/Oct, else NULL."""
    x = F.to_date(_as_col(d))
    out = F.lit(None).cast("string")
    for month, code in sorted(PERIOD_TYPE_BY_MONTH.items(), reverse=True):
        out = F.when((F.dayofmonth(x) == 1) & (F.month(x) == month), F.lit(code)).otherwise(out)
    return out


def period_window(d: str | Column, shift_days: int = 1, year_label: bool = False) -> dict[str, Column]:
    """Columns ``periode_fom, periode_tom, max_vedtaksdato, periode_label`` for a run date.

    * tom: month before the run date;
    * fom: run date minus the type's look-back (NULL when the date has no type);
    * max date: run date plus ``shift_days``;
    * label: ``S`` + tom, ``H``/``K`` + fom, ``A`` + fom.  The yearly label keeps the
      whole ``yyyyMM`` of fom, which is what the scheduler job produces (it formats
      a text value with a date pattern, a no-op); ``year_label=True`` gives the
      intended ``A`` + year instead.
    """
    x = F.to_date(_as_col(d))
    typ = period_type(x)
    tom = month_text(x, -1)
    fom = F.lit(None).cast("string")
    for code, back in LOOKBACK_MONTHS.items():
        fom = F.when(typ == code, month_text(x, -back)).otherwise(fom)
    year_part = F.substring(fom, 1, 4) if year_label else fom
    label = (F.when(typ == "A", F.concat(F.lit("A"), year_part))
             .when(typ == "S", F.concat(F.lit("S"), tom))
             .when(typ.isin("H", "K"), F.concat(typ, fom)))
    return {
        "periode_fom": fom,
        "periode_tom": tom,
        "max_vedtaksdato": F.date_format(F.date_add(x, shift_days), "yyyyMMdd"),
        "periode_label": label,
    }


def daily_window(d: str | Column, back_months: int = 4, ahead_months: int = 14,
                 shift_days: int = 1) -> dict[str, Column]:
    """Daily run: fom -4 months, tom +14 months, max date +1 day, type ``D``."""
    x = F.to_date(_as_col(d))
    return {
        "periode_fom": month_text(x, -back_months),
        "periode_tom": month_text(x, ahead_months),
        "max_vedtaksdato": F.date_format(F.date_add(x, shift_days), "yyyyMMdd"),
        "periode_type": F.lit("D"),
    }


def _blank(v: Column, null_is_blank: bool) -> Column:
    """Exactly the empty text (no trimming), and NULL when ``null_is_blank``."""
    empty = v.cast("string") == ""
    return (v.isNull() | empty) if null_is_blank else F.coalesce(empty, F.lit(False))


def blank_default(value: str | Column, default: Column | str | int, cast: str | None = None,
                  null_is_blank: bool = True) -> Column:
    """Setting with a default: ``""`` (or NULL) -> default, else ``cast(value)``.

    Only the empty text counts as blank; a value of spaces is cast like any other.
    """
    v = _as_col(value)
    dflt = default if isinstance(default, Column) else F.lit(default)
    given = v.cast(cast) if cast else v
    if cast:
        dflt = dflt.cast(cast)
    return F.when(_blank(v, null_is_blank), dflt).otherwise(given)


def coupled_default(period: str | Column, flag: str | Column, default_period: Column | str,
                    default_flag: int = 1, null_is_blank: bool = False) -> tuple[Column, Column]:
    """A blank period sets both the period *and* the flag to their defaults.

    The monthly job compares the period with ``""`` only, so by default a NULL
    period is kept (with the given flag); ``null_is_blank=True`` treats it as blank.
    """
    p = _as_col(period)
    f = _as_col(flag)
    dp = default_period if isinstance(default_period, Column) else F.lit(default_period)
    blank = _blank(p, null_is_blank)
    return (F.when(blank, dp).otherwise(p.cast("string")),
            F.when(blank, F.lit(default_flag)).otherwise(f.cast("int")))


def week_cycle(d: str | Column, names: Sequence[str], unknown: str = "unknown") -> Column:
    """Name on duty for the ISO week of ``d``: weeks 1..53 go round-robin over ``names``."""
    if not names:
        raise ValueError("names must not be empty")
    arr = F.array(*[F.lit(n) for n in names])
    wk = F.weekofyear(F.to_date(_as_col(d)))
    return F.coalesce(F.element_at(arr, ((wk - 1) % len(names) + 1).cast("int")), F.lit(unknown))


def month_start(yyyymm: str) -> _dt.date:
    return _dt.date(int(yyyymm[:4]), int(yyyymm[4:6]), 1)


def next_month_start(yyyymm: str) -> _dt.date:
    y, m = int(yyyymm[:4]), int(yyyymm[4:6])
    return _dt.date(y + (m == 12), m % 12 + 1, 1)


def period_range(d: str | Column, fom: str, tom: str, max_date: str | None = None) -> Column:
    """``yyyyMM(d) BETWEEN fom AND tom AND d <= max_date`` as a plain range on ``d``.

    Written as bounds on the column itself so that parquet statistics and
    partition pruning apply (a function of the column would not push down).
    ``max_date`` is ``yyyyMMdd`` and inclusive for the whole day.
    """
    x = _as_col(d)
    lo = month_start(fom)
    hi = next_month_start(tom)
    if max_date:
        md = _dt.datetime.strptime(max_date, "%Y%m%d").date() + _dt.timedelta(days=1)
        hi = min(hi, md)
    lo_ts = F.lit(lo.isoformat() + " 00:00:00").cast("timestamp_ntz")
    hi_ts = F.lit(hi.isoformat() + " 00:00:00").cast("timestamp_ntz")
    return (x >= lo_ts) & (x < hi_ts)


__all__ = ["month_text", "prev_period", "prev_month_end", "period_type", "period_window",
           "daily_window", "blank_default", "coupled_default", "week_cycle", "period_range",
           "month_start", "next_month_start", "PERIOD_TYPE_BY_MONTH", "LOOKBACK_MONTHS"]

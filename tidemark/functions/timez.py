"""Time conversions with explicit zones (session zone independent).

Timestamps without zone (``TIMESTAMP_NTZ``) are wall-clock values; the helpers
here never rely on ``spark.sql.session.timeZone``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH_NTZ = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def _as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz_to_unix_ms(ts: str | Column) -> Column:
    """Milliseconds since the epoch of a UTC wall-clock ``TIMESTAMP_NTZ`` (floor).

    Built from the value's fields: ``timestamp_diff`` would route the zone-less
    value through the session zone, which moves times in a DST gap.
    """
    t = _as_col(ts)
    days = F.datediff(F.to_date(t), F.lit("1970-01-01").cast("date")).cast("long")
    sec_ms = F.floor(F.extract(F.lit("SECOND"), t) * 1000).cast("long")
    return (days * 86_400_000 + F.hour(t).cast("long") * 3_600_000
            + F.minute(t).cast("long") * 60_000 + sec_ms)


def unix_ms_to_ntz(ms: str | Column) -> Column:
    """UTC wall clock (``TIMESTAMP_NTZ``) of epoch milliseconds."""
    return F.timestamp_add("MILLISECOND", _as_col(ms), F.expr(EPOCH_NTZ))


def unix_ms_to_local(ms: str | Column, zone: str = "Europe/Oslo") -> Column:
    """Ingest function ``int-unix-ms -> datetime-no``: epoch ms to local wall clock.

    On the autumn DST night two instants map to one local time; that is the
    nature of a zone-less local column.
    """
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), unix_ms_to_ntz(ms))


def shift_zone(ts: str | Column, source_zone: str, target_zone: str) -> Column:
    """Wall clock in ``source_zone`` to wall clock in ``target_zone`` (``AT TIME ZONE``)."""
    return F.convert_timezone(F.lit(source_zone), F.lit(target_zone), _as_col(ts))


def local_day(ts: str | Column, source_zone: str = "UTC",
              target_zone: str = "Europe/Belgrade") -> Column:
    """``trunc(CAST(ts AT TIME ZONE target AS TIMESTAMP), 'dd')`` as a DATE."""
    return F.to_date(shift_zone(ts, source_zone, target_zone))


def parse_ts_ms(text: str | Column, lenient: bool = True) -> Column:
    """``yyyy-MM-dd'T'HH:mm:ss.SSS`` text to ``TIMESTAMP_NTZ``.

    ``lenient`` gives NULL for bad text (``try_to_timestamp``); otherwise bad
    text fails the query like the database function does.
    """
    fmt = F.lit("yyyy-MM-dd'T'HH:mm:ss.SSS")
    t = _as_col(text)
    if lenient:
        # CASE evaluates the strict parser only where the lenient one succeeded.
        return F.when(F.try_to_timestamp(t, fmt).isNotNull(), F.to_timestamp_ntz(t, fmt))
    return F.to_timestamp_ntz(t, fmt)


def minute(ts: str | Column) -> Column:
    """``trunc(x, 'Mi')`` of a ``TIMESTAMP_NTZ``, built from its fields.

    ``date_trunc`` would cast the zone-less value through the session zone
    first, which moves wall-clock times that fall into a DST gap of that zone.
    """
    t = _as_col(ts)
    return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.minute(t),
                                F.lit(0))


def ts_literal(value: _dt.datetime | _dt.date | str) -> Column:
    """A ``TIMESTAMP_NTZ`` literal (``as_of`` / ``sysdate`` arguments)."""
    if isinstance(value, str):
        value = _dt.datetime.fromisoformat(value)
    if isinstance(value, _dt.date) and not isinstance(value, _dt.datetime):
        value = _dt.datetime(value.year, value.month, value.day)
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def days_before(as_of: _dt.datetime | str, days: int) -> Column:
    """``sysdate - n`` with ``sysdate`` an argument."""
    return ts_literal(as_of) - F.expr(f"INTERVAL {int(days)} DAYS")


def midnight_days_before(as_of: _dt.datetime | str, days: int) -> Column:
    """``trunc(sysdate,'dd') - n`` as a timestamp, so the compare keeps pushdown."""
    return F.to_date(ts_literal(as_of)).cast("timestamp_ntz") - F.expr(f"INTERVAL {int(days)} DAYS")


def date_text(text: str, fmt: str = "dd.MM.yyyy") -> Column:
    """``TO_DATE('01.08.2023','dd.mm.yyyy')`` as a timestamp literal."""
    return F.to_timestamp_ntz(F.lit(text), F.lit(fmt))


__all__ = ["ntz_to_unix_ms", "unix_ms_to_ntz", "unix_ms_to_local", "shift_zone", "local_day",
           "parse_ts_ms", "minute", "ts_literal", "days_before", "midnight_days_before",
           "date_text"]

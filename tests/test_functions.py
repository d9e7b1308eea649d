"""Scalar functions: JSON_VALUE rules, zones and DST, reporting periods."""

import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import functions as F

from tidemark.functions import (blank_default, coupled_default, daily_window, dot_line,
                                json_value, local_day, parse_ts_ms, period_type, period_window,
                                prev_month_end, prev_period, unix_ms_to_local, week_cycle)
from tidemark.functions.timez import ntz_to_unix_ms


def test_json_value_rules(spark):
    docs = ['{"k": 1}', '{"k": {"a": 1}}', '{"k": [1, 2]}', '{"k": "{\\"x\\": 1}"}', '{"k": null}',
            'broken', '{"a": 1}', '{"k": true}', '{"k": "tekst"}', None]
    df = spark.createDataFrame([(d,) for d in docs], "doc string")
    got = [r[0] for r in df.select(json_value("doc", "$.k")).collect()]
    assert got == ["1", None, None, '{"x": 1}', None, None, None, "true", "tekst", None]


def test_json_value_non_ascii_key(spark):
    df = spark.createDataFrame([('{"søker": "123", "a": {"b": "x"}}',)], "doc string")
    r = df.select(json_value("doc", "$.søker"), json_value("doc", "$.a.b")).first()
    assert tuple(r) == ("123", "x")


def test_unix_ms_to_oslo_on_dst_nights(spark):
    oslo = ZoneInfo("Europe/Oslo")
    instants = [dt.datetime(2024, 3, 31, 0, 59, tzinfo=dt.timezone.utc),
                dt.datetime(2024, 3, 31, 1, 0, tzinfo=dt.timezone.utc),
                dt.datetime(2024, 10, 27, 0, 30, tzinfo=dt.timezone.utc),
                dt.datetime(2024, 10, 27, 1, 30, tzinfo=dt.timezone.utc),
                dt.datetime(2024, 7, 1, 12, 0, 0, 123000, tzinfo=dt.timezone.utc)]
    ms = [int(i.timestamp() * 1000) for i in instants]
    df = spark.createDataFrame([(m,) for m in ms], "ms long")
    got = [r[0] for r in df.select(unix_ms_to_local("ms")).collect()]
    want = [i.astimezone(oslo).replace(tzinfo=None) for i in instants]
    assert got == want
    # the two autumn instants share one local hour
    assert got[2].hour == got[3].hour == 2


def test_ntz_ms_roundtrip_truncates(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 7, 179575),)], "ts timestamp_ntz")
    assert df.select(ntz_to_unix_ms("ts")).first()[0] == 1704067207179


def test_local_day_belgrade(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 22, 59),), (dt.datetime(2024, 1, 1, 23, 0),),
                                (dt.datetime(2024, 7, 1, 21, 59),), (dt.datetime(2024, 7, 1, 22, 0),)],
                               "ts timestamp_ntz")
    got = [r[0] for r in df.select(local_day("ts", "UTC", "Europe/Belgrade")).collect()]
    assert got == [dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 7, 1), dt.date(2024, 7, 2)]


def test_parse_ts_lenient(spark):
    df = spark.createDataFrame([("2024-01-02T03:04:05.678",), ("nonsense",), (None,)], "s string")
    got = [r[0] for r in df.select(parse_ts_ms("s")).collect()]
    assert got == [dt.datetime(2024, 1, 2, 3, 4, 5, 678000), None, None]


def _py_prev_period(d):
    return (d.replace(day=1) - dt.timedelta(days=1)).strftime("%Y%m")


def _py_prev_month_end(d):
    return (d.replace(day=1) - dt.timedelta(days=1)).strftime("%Y%m%d")


def _py_type(d):
    return {1: "A", 4: "K", 7: "H", 10: "S"}.get(d.month) if d.day == 1 else None


def _shift_months(d, n):
    y, m = divmod(d.month - 1 + n, 12)
    y += d.year
    m += 1
    import calendar
    return dt.date(y, m, min(d.day, calendar.monthrange(y, m)[1]))


def test_periods_against_python_for_ten_years(spark):
    days = spark.range(0, 3653).select(F.date_add(F.lit("2015-01-01").cast("date"),
                                                  F.col("id").cast("int")).alias("d"))
    win = period_window("d")
    dw = daily_window("d")
    out = days.select("d", prev_period("d").alias("pp"), prev_month_end("d").alias("pe"),
                      period_type("d").alias("pt"), *[c.alias(n) for n, c in win.items()],
                      dw["periode_fom"].alias("dfom"), dw["periode_tom"].alias("dtom"),
                      dw["max_vedtaksdato"].alias("dmax")).collect()
    assert len(out) == 3653
    back = {"A": 12, "S": 9, "H": 6, "K": 3}
    for r in out:
        d = r["d"]
        assert r["pp"] == _py_prev_period(d)
        assert r["pe"] == _py_prev_month_end(d)
        t = _py_type(d)
        assert r["pt"] == t
        assert r["periode_tom"] == _shift_months(d, -1).strftime("%Y%m")
        assert r["max_vedtaksdato"] == (d + dt.timedelta(days=1)).strftime("%Y%m%d")
        if t is None:
            assert r["periode_fom"] is None and r["periode_label"] is None
        else:
            fom = _shift_months(d, -back[t]).strftime("%Y%m")
            assert r["periode_fom"] == fom
            assert r["periode_label"] == t + (r["periode_tom"] if t == "S" else fom)
        assert r["dfom"] == _shift_months(d, -4).strftime("%Y%m")
        assert r["dtom"] == _shift_months(d, 14).strftime("%Y%m")
        assert r["dmax"] == (d + dt.timedelta(days=1)).strftime("%Y%m%d")


def test_special_days(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 2, 29),),
                                (dt.date(2024, 3, 31),), (dt.date(2020, 12, 31),)], "d date")
    r = df.select(prev_period("d"), prev_month_end("d"), period_type("d"),
                  week_cycle("d", ["a", "b", "c"]), F.weekofyear("d")).collect()
    assert [tuple(x) for x in r] == [
        ("202312", "20231231", "A", "a", 1),
        ("202401", "20240131", None, "c", 9),
        ("202402", "20240229", None, "a", 13),
        ("202011", "20201130", None, "b", 53),
    ]


def test_year_label_switch(spark):
    df = spark.createDataFrame([(dt.date(2025, 1, 1),)], "d date")
    a = df.select(period_window("d")["periode_label"]).first()[0]
    b = df.select(period_window("d", year_label=True)["periode_label"]).first()[0]
    assert (a, b) == ("A202401", "A2024")


def test_blank_and_coupled_defaults(spark):
    df = spark.createDataFrame([("", "", 0), (None, None, 0), ("7", "202305", 0), ("8", "202306", 1)],
                               "v string, p string, f int")
    p, f = coupled_default("p", "f", "202312")
    got = [tuple(r) for r in df.select(blank_default("v", 1, "int"), p, f).collect()]
    # "" is blank everywhere; NULL is blank for settings with a default, while the
    # coupled period keeps NULL (the monthly job compares with "" only)
    assert got == [(1, "202312", 1), (1, None, 0), (7, "202305", 0), (8, "202306", 1)]
    p2, f2 = coupled_default("p", "f", "202312", null_is_blank=True)
    assert [tuple(r) for r in df.select(p2, f2).collect()][1] == ("202312", 1)


def test_dot_line(spark):
    df = spark.createDataFrame([("Count", 12)], "l string, v long")
    line = df.select(dot_line("l", "v", 12)).first()[0]
    assert line == "Count.......12"


def test_minute_truncation_ignores_session_zone(spark):
    from tidemark.functions import minute
    df = spark.createDataFrame([(dt.datetime(2024, 3, 31, 2, 30, 59, 999999),),
                                (dt.datetime(2024, 3, 10, 2, 15, 1),)], "ts timestamp_ntz")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "Europe/Oslo", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = [r[0] for r in df.select(minute("ts")).collect()]
            assert got == [dt.datetime(2024, 3, 31, 2, 30), dt.datetime(2024, 3, 10, 2, 15)], zone
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_epoch_ms_and_month_text_in_a_dst_gap(spark):
    from tidemark.functions.periods import month_text
    from tidemark.functions.timez import unix_ms_to_ntz
    df = spark.createDataFrame([(dt.datetime(2024, 3, 10, 2, 30, 1, 500000),),
                                (dt.datetime(2024, 3, 31, 23, 30),)], "ts timestamp_ntz")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York", "America/Santiago"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            rows = df.select(ntz_to_unix_ms("ts").alias("ms"), month_text("ts").alias("m"),
                             unix_ms_to_ntz(ntz_to_unix_ms("ts")).alias("back")).collect()
            assert [r["ms"] for r in rows] == [1710037801500, 1711927800000], zone
            assert [r["m"] for r in rows] == ["202403", "202403"], zone
            assert [r["back"] for r in rows] == [dt.datetime(2024, 3, 10, 2, 30, 1, 500000),
                                                 dt.datetime(2024, 3, 31, 23, 30)], zone
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_period_range_bounds(spark):
    from tidemark.functions import period_range
    ts = [dt.datetime(2023, 12, 31, 23, 59), dt.datetime(2024, 1, 1), dt.datetime(2024, 3, 15, 23, 59),
          dt.datetime(2024, 3, 16), dt.datetime(2024, 3, 31, 12), dt.datetime(2024, 4, 1)]
    df = spark.createDataFrame([(t,) for t in ts], "ts timestamp_ntz")
    a = [r[0] for r in df.where(period_range("ts", "202401", "202403")).collect()]
    assert a == ts[1:5]
    b = [r[0] for r in df.where(period_range("ts", "202401", "202403", "20240315")).collect()]
    assert b == ts[1:3]   # the max date is inclusive for the whole day
    c = [r[0] for r in df.where(period_range("ts", "202312", "202312")).collect()]
    assert c == ts[:1]    # December rolls over to January


def test_parse_ts_strict_raises_on_bad_text(spark):
    import pytest
    ok = spark.createDataFrame([("2024-01-02T03:04:05.678",)], "s string")
    assert ok.select(parse_ts_ms("s", lenient=False)).first()[0] == dt.datetime(2024, 1, 2, 3, 4, 5, 678000)
    if spark.conf.get("spark.sql.ansi.enabled") == "true":
        bad = spark.createDataFrame([("nonsense",)], "s string")
        with pytest.raises(Exception):
            bad.select(parse_ts_ms("s", lenient=False)).collect()


def test_long_labels_stay_whole(spark):
    from tidemark.functions.text import dot_line
    long = "x" * 70
    df = spark.createDataFrame([(long, 5), ("ab", 7)], "l string, v int")
    assert [r[0] for r in df.select(dot_line("l", "v")).collect()] == [long + "5", "ab" + "." * 58 + "7"]


def test_json_containers_with_repeated_and_dotted_keys(spark):
    from tidemark.functions.json import json_key, json_value
    docs = ['{"k":{"a":1},"k":2}', '{"k":{"a":1,"a":2}}', '{"k":[1,2]}', '{"k":"{\\"a\\":1}"}', '{"k":"[x]"}', '{"k":null}',
            "{broken", '{"k":3,"z":1,"z":2}', None]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i int, d string")
    got = [r[0] for r in df.orderBy("i").select(json_value("d", "$['k']")).collect()]
    assert got[1:] == [None, None, '{"a":1}', "[x]", None, None, "3", None]
    assert got[0] in (None, "2")
    dotted = spark.createDataFrame([('{"a.b":"x","a":{"b":"y"}}',)], "d string")
    assert tuple(dotted.select(json_key("d", "a.b"), json_key("d", "a/b")).first()) == ("x", "y")

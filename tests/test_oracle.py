"""Every registered query against its DuckDB oracle on the driver tables (sf0.001),
plus the smoke entry."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

from __spark_entry__ import entry
from tidemark.plans.catalog import QUERIES
from tidemark.plans.oracle import ORACLE_SQL
from tests.conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _key(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    yield con
    con.close()


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["topic", "n_gaps", "n_missing", "max_missing"]
    got = sorted(tuple(r) for r in df.collect())
    con = duckdb.connect()
    want = con.sql(f"""
        SELECT event_type, COUNT(*), SUM(nxt - event_id - 1), MAX(nxt - event_id - 1) FROM (
          SELECT event_type, event_id,
                 LEAD(event_id) OVER (PARTITION BY event_type ORDER BY event_id) AS nxt
          FROM '{SF_SMALL}/events.parquet') t
        WHERE nxt - event_id > 1 GROUP BY event_type""").fetchall()
    assert got == sorted(tuple(int(x) if not isinstance(x, str) else x for x in r) for r in want)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SF_SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    res = duck.sql(ORACLE_SQL[key])
    assert sorted(df.columns) == sorted(res.columns)
    assert _key(s_rows, df.columns) == _key(res.fetchall(), res.columns)


ZONE_KEYS = ["local_decision_day", "unix_ms_local", "interval_slice", "recent_count", "recent_days",
             "unpivot_distinct", "reconcile_diff", "star_distinct", "patched_rows",
             "period_filter", "ingest_map", "run_success_counts", "prev_period", "gap_count_since"]


@pytest.mark.parametrize("key", ZONE_KEYS)
def test_results_do_not_depend_on_session_zone(spark, duck, key):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = QUERIES[key](spark, SF_SMALL)
        s_rows = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    res = duck.sql(ORACLE_SQL[key])
    assert _key(s_rows, df.columns) == _key(res.fetchall(), res.columns)


def test_gap_checks_in_one_report_equal_standalone(spark):
    from tidemark.plans import catalog as c
    from tidemark.plans.reports import union_metrics
    parts = {"a": c.q_gap_count(spark, SF_SMALL), "b": c.q_gap_count_typed(spark, SF_SMALL),
             "c": c.q_gap_count_since(spark, SF_SMALL), "d": c.q_gap_count_partitioned(spark, SF_SMALL)}
    together = {r["metric"]: r["value"] for r in union_metrics(parts).collect()}
    assert together == {k: v.first()[0] for k, v in parts.items()}


FORBIDDEN_PLAN_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas",
                        "FlatMapGroupsInPandas", "BroadcastNestedLoopJoin", "CartesianProduct")


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_plans_have_no_python_and_no_nested_loops(spark, key):
    import contextlib
    import io
    df = QUERIES[key](spark, SF_SMALL)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    plan = buf.getvalue()
    assert not [n for n in FORBIDDEN_PLAN_NODES if n in plan], plan[:2000]


PUSHDOWN = {
    "gap_count": "GreaterThan(event_id,1000)",
    "interval_slice": "GreaterThanOrEqual(ts,2024-01-10T00:00)",
    "recent_days": "GreaterThanOrEqual(ts,2024-01-24T00:00)",
    "period_filter": "LessThan(l_shipdate,1998-06-16T00:00)",
    "run_success_counts": "EqualTo(o_orderstatus,F)",
    "gap_count_partitioned": "GreaterThan(l_shipdate,1996-04-16T00:00)",
}


@pytest.mark.parametrize("key", sorted(PUSHDOWN))
def test_bounds_reach_the_parquet_scan(spark, key):
    import contextlib
    import io
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            QUERIES[key](spark, SF_SMALL).explain("formatted")
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)
    pushed = [line for line in buf.getvalue().splitlines() if line.startswith("PushedFilters")]
    assert any(PUSHDOWN[key] in line for line in pushed), pushed


READ_COLUMNS = {"gap_count": {"event_id", "event_type"}, "recent_count": {"ts"},
                "typed_counts": {"ts", "event_type"}, "table_scan": {"n_nationkey", "n_name"}}


@pytest.mark.parametrize("key", sorted(READ_COLUMNS))
def test_scans_read_only_needed_columns(spark, key):
    import contextlib
    import io
    import re
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        QUERIES[key](spark, SF_SMALL).explain("formatted")
    for line in buf.getvalue().splitlines():
        if line.startswith("ReadSchema"):
            cols = set(re.findall(r"([A-Za-z_][A-Za-z0-9_]*):", line.split("struct<", 1)[1]))
            assert cols <= READ_COLUMNS[key], line

import pytest
"""Join, reshape, count and refresh operators on hand-made rows (NULL rules)."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import (distinct_by_code, new_values, not_in_values, reconcile,
                                recent_counts, run_success_counts, run_success_report,
                                typed_counts, unmatched, unpivot_nonnull, validity_join)
from tidemark.operators.refresh import period_refresh, write_periodic
from tidemark.plans.reports import gap_alert, metric_rows, report_lines
from tidemark.session import work_dir


def _vals(df, col=None):
    return sorted((tuple(r) if col is None else r[col]) for r in df.collect())


def test_not_in_null_rules(spark):
    vals = spark.createDataFrame([(1,), (2,), (None,), (2,)], "v long")
    dom = spark.createDataFrame([(1,)], "d long")
    dom_null = spark.createDataFrame([(1,), (None,)], "d long")
    empty = spark.createDataFrame([], "d long")
    assert _vals(not_in_values(vals, "v", dom, "d"), 0) == [2]
    assert _vals(not_in_values(vals, "v", dom_null, "d")) == []
    got = [r[0] for r in not_in_values(vals, "v", empty, "d").collect()]
    assert sorted(got, key=lambda x: (x is None, x)) == [1, 2, None]


def test_not_in_matches_spark_sql(spark):
    vals = spark.createDataFrame([(i % 7 if i % 5 else None,) for i in range(40)], "v long")
    dom = spark.createDataFrame([(i,) for i in range(0, 7, 2)], "d long")
    vals.createOrReplaceTempView("t_vals")
    dom.createOrReplaceTempView("t_dom")
    want = _vals(spark.sql("SELECT DISTINCT v FROM t_vals WHERE v NOT IN (SELECT d FROM t_dom)"))
    assert _vals(not_in_values(vals, "v", dom, "d")) == want


def test_new_values_reports_null(spark):
    vals = spark.createDataFrame([("a",), ("b",), (None,), ("a",)], "v string")
    dom = spark.createDataFrame([("a",), (None,)], "d string")
    got = [r[0] for r in new_values(vals, "v", dom, "d").collect()]
    assert sorted(got, key=lambda x: (x is None, x)) == ["b", None]


def test_unmatched_keeps_null_keys_and_no_duplication(spark):
    left = spark.createDataFrame([("u1",), ("u2",), (None,)], "k string")
    right = spark.createDataFrame([("u1",), ("u1",)], "c string")
    assert unmatched(left, right, "k", "c").count() == 2


def test_validity_join_intervals(spark):
    facts = spark.createDataFrame([("p", dt.date(2024, 1, 10)), ("q", dt.date(2024, 1, 5)),
                                   ("r", dt.date(2024, 1, 1))], "person string, day date")
    dim = spark.createDataFrame([
        ("p", dt.date(2024, 1, 1), dt.date(2024, 1, 10)),   # touching end, inclusive
        ("p", dt.date(2024, 1, 10), dt.date(2024, 1, 20)),  # overlap -> second row
        ("q", dt.date(2024, 1, 5), dt.date(2024, 1, 5)),    # one-day interval
        ("r", dt.date(2024, 1, 2), dt.date(2024, 1, 3)),    # outside
    ], "off_id string, fra date, til date")
    j = validity_join(facts, dim, "person", "off_id", "day", "fra", "til")
    assert j.count() == 3


def test_unpivot_drops_null_cells(spark):
    df = spark.createDataFrame([("x", 1, 2.0, None), ("y", 2, None, None), ("x", 3, 1.0, 5.0)],
                               "g string, id long, a double, b double")
    long = unpivot_nonnull(df, ["g", "id"], {"A": "a", "B": "b"})
    assert long.count() == 3   # row y has only NULL cells and disappears
    agg = distinct_by_code(df, ["g"], {"A": "a", "B": "b"}, "id")
    assert _vals(agg) == [("x", "A", 2), ("x", "B", 1)]


def test_reconcile_missing_right_key(spark):
    left = spark.createDataFrame([("m1", "g", "area1", 5), ("m1", "g", "area2", 2), ("m2", "g", "a", 9)],
                                 "p string, k string, area string, n long")
    right = spark.createDataFrame([("m1", "g", 3)], "p string, k string, n long")
    out = reconcile(left, right, ["p", "k"], "n", "n", right_name="n_right")
    assert _vals(out.select("p", "area", "diff")) == [("m1", "area1", 2)]
    out2 = reconcile(left, right, ["p", "k"], "n", "n", right_name="n_right", report_missing=True)
    assert out2.count() == 2


def test_counts_windows(spark):
    as_of = dt.datetime(2024, 1, 31)
    ts = [as_of - dt.timedelta(days=d) for d in (0.5, 1, 1.5, 7, 7.5, 8, 9)]
    df = spark.createDataFrame([(t, "a" if i % 2 else "b") for i, t in enumerate(ts)],
                               "ts timestamp_ntz, typ string")
    r = recent_counts(df, "ts", as_of, {"d1": (1, True), "d7": (7, True), "d8x": (8, False)}).first()
    assert tuple(r) == (2, 4, 5)
    r2 = typed_counts(df, "ts", as_of, 7, "typ", {"n_a": "a"}).first()
    assert tuple(r2) == (4, 2)


def test_run_success_half_open(spark):
    a, b = dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 2, 10)
    runs = spark.createDataFrame([("d1", "success", a), ("d1", "success", b), ("d1", "failed", a),
                                  ("d2", "success", a + dt.timedelta(hours=1))],
                                 "dag_id string, state string, execution_date timestamp_ntz")
    c = run_success_counts(runs, "dag_id", "state", "execution_date", a, b)
    assert _vals(c) == [("d1", 1), ("d2", 1)]
    txt = run_success_report(c).first()[0]
    assert txt == "DAG ID: d1, Success Count: 1\nDAG ID: d2, Success Count: 1"


def test_reports(spark):
    row = spark.createDataFrame([(3, 0)], "x long, y long")
    m = metric_rows(row)
    assert _vals(m) == [(1, "x", 3), (2, "y", 0)]
    lines = report_lines(m, {"x": "Ex"}, width=6).orderBy("pos").collect()
    assert [r["line"] for r in lines] == ["Ex....3", "y.....0"]
    none = gap_alert({"t1": spark.createDataFrame([(0,)], "n long")}).first()[0]
    some = gap_alert({"t2": spark.createDataFrame([(2,)], "n long"),
                      "t1": spark.createDataFrame([(1,)], "n long")}).first()[0]
    assert none.startswith("No gaps")
    assert "t1, t2" in some


def test_period_refresh(spark):
    rows = [("202401", 1, "old"), ("202402", 2, "old"), (None, 3, "old")]
    schema = "periode string, id long, v string"
    target = work_dir(spark, "t-refresh")
    write_periodic(spark.createDataFrame(rows, schema), target, "periode")
    src = spark.createDataFrame([("202402", 4, "new"), ("202403", 5, "new")], schema)
    out = period_refresh(spark, target, src, "periode", "202402")
    got = sorted((tuple(r) for r in out.select("periode", "id", "v").collect()), key=str)
    # 202402 replaced, 202403 added (source not filtered), NULL period kept
    want = [("202401", 1, "old"), ("202402", 4, "new"), ("202403", 5, "new"), (None, 3, "old")]
    assert got == sorted(want, key=str)
    # a source without the period still deletes it
    out2 = period_refresh(spark, target, src.where(F.col("periode") == "202403"), "periode", "202401")
    assert sorted(r["id"] for r in out2.collect()) == [3, 4, 5, 5]


def test_monthly_reconciliation(spark):
    from tidemark.plans.reports import monthly_reconciliation
    wide = spark.createDataFrame([
        ("202401", "G1", "n1", 1, 10.0, None),
        ("202401", "G1", "n1", 2, None, None),
        ("202401", "G1", "n1", 3, 5.0, 1.0),
        ("202402", "G1", "n1", 1, 1.0, None),
    ], "periode string, grp string, grp_name string, person long, a double, b double")
    fact = spark.createDataFrame([
        ("202401", "G1", "A", "area x", 3),   # 3 > 2 -> kept
        ("202401", "G1", "B", "area x", 1),   # 1 = 1 -> dropped
        ("202401", "G1", "B", "area y", 2),   # 2 > 1 -> kept (two left rows meet one right)
        ("202402", "G1", "B", "area x", 4),   # no wide row for B in 202402 -> NULL diff
    ], "periode string, grp string, code string, area string, n_distinct long")
    out = monthly_reconciliation(wide, ["periode", "grp", "grp_name"], {"A": "a", "B": "b"}, "person",
                                 fact, ["periode", "grp", "code"])
    got = sorted((r["periode"], r["code"], r["area"], r["diff_n_distinct"]) for r in out.collect())
    assert got == [("202401", "A", "area x", 1), ("202401", "B", "area y", 1)]
    only = monthly_reconciliation(wide, ["periode", "grp", "grp_name"], {"A": "a", "B": "b"}, "person",
                                  fact, ["periode", "grp", "code"], period="202402",
                                  report_missing=True)
    assert [(r["code"], r["diff_n_distinct"]) for r in only.collect()] == [("B", None)]


def test_salted_joins_equal_plain(spark):
    facts = spark.createDataFrame(
        [("hot", dt.date(2024, 1, 1 + i % 20), i) for i in range(300)]
        + [("cold", dt.date(2024, 1, 5), 1000), (None, dt.date(2024, 1, 5), 1001)],
        "person string, day date, n long")
    dim = spark.createDataFrame([("hot", dt.date(2024, 1, 1), dt.date(2024, 1, 10)),
                                 ("hot", dt.date(2024, 1, 8), dt.date(2024, 1, 31)),
                                 ("cold", dt.date(2024, 2, 1), dt.date(2024, 2, 2))],
                                "off_id string, fra date, til date")
    plain = validity_join(facts, dim, "person", "off_id", "day", "fra", "til")
    salted = validity_join(facts, dim, "person", "off_id", "day", "fra", "til", salt=7)
    assert salted.columns == plain.columns
    assert _vals(salted) == _vals(plain)
    right = spark.createDataFrame([("hot",), ("hot",)], "c string")
    a = unmatched(facts, right, "person", "c")
    b = unmatched(facts, right, "person", "c", salt=5)
    assert b.columns == facts.columns
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert b.count() == 2


def test_pre_aggregated_counts_equal_row_counts(spark):
    from tidemark.operators.joins import unmatched_count, validity_join_count
    facts = spark.createDataFrame(
        [("hot", dt.date(2024, 1, 1 + i % 20)) for i in range(300)]
        + [("hot", dt.date(2024, 1, 3))] * 50 + [("cold", dt.date(2024, 1, 5)), (None, dt.date(2024, 1, 5))],
        "person string, day date")
    dim = spark.createDataFrame([("hot", dt.date(2024, 1, 1), dt.date(2024, 1, 10)),
                                 ("hot", dt.date(2024, 1, 8), dt.date(2024, 1, 31)),
                                 ("cold", dt.date(2024, 2, 1), dt.date(2024, 2, 2))],
                                "off_id string, fra date, til date")
    rows = validity_join(facts, dim, "person", "off_id", "day", "fra", "til").count()
    assert validity_join_count(facts, dim, "person", "off_id", "day", "fra", "til").first()[0] == rows
    right = spark.createDataFrame([("hot",)], "c string")
    assert unmatched_count(facts, right, "person", "c").first()[0] == \
        unmatched(facts, right, "person", "c").count() == 2


def test_report_text_orders_lines(spark):
    from tidemark.plans.reports import report_text
    lines = spark.createDataFrame([(2, "b...2"), (1, "a...1")], "pos int, line string")
    assert report_text(lines, "Head").first()[0] == "Head\na...1\nb...2"
    assert report_text(lines).first()[0] == "a...1\nb...2"


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

maybe_ints = st.lists(st.one_of(st.none(), st.integers(0, 9)), min_size=0, max_size=15)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=maybe_ints, domain=maybe_ints, distinct=st.booleans())
def test_not_in_equals_sql_not_in(spark, values, domain, distinct):
    v = spark.createDataFrame([(x,) for x in values], "v long")
    d = spark.createDataFrame([(x,) for x in domain], "d long")
    v.createOrReplaceTempView("p_vals")
    d.createOrReplaceTempView("p_dom")
    sel = "SELECT DISTINCT v" if distinct else "SELECT v"
    want = spark.sql(f"{sel} FROM p_vals WHERE v NOT IN (SELECT d FROM p_dom)").collect()
    got = not_in_values(v, "v", d, "d", distinct=distinct).collect()
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, want), key=key)


wide_rows = st.lists(st.tuples(st.sampled_from(["g1", "g2"]), st.one_of(st.none(), st.integers(0, 5)),
                               st.one_of(st.none(), st.integers(1, 3)),
                               st.one_of(st.none(), st.integers(1, 3))), min_size=0, max_size=25)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=wide_rows)
def test_distinct_by_code_equals_sql_unpivot(spark, rows):
    df = spark.createDataFrame(rows, "g string, e long, a long, b long")
    df.createOrReplaceTempView("p_wide")
    want = spark.sql("""
        SELECT g, code, COUNT(DISTINCT CASE WHEN amount IS NOT NULL THEN e END) AS n
        FROM p_wide UNPIVOT (amount FOR code IN (a AS A, b AS B))
        GROUP BY g, code""").collect()
    got = distinct_by_code(df, ["g"], {"A": "a", "B": "b"}, "e", name="n").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


fact_rows = st.lists(st.tuples(st.one_of(st.none(), st.sampled_from(["p", "q", "r"])),
                               st.integers(1, 10)), min_size=0, max_size=30)
dim_rows = st.lists(st.tuples(st.sampled_from(["p", "q", "s"]), st.integers(1, 10), st.integers(0, 4)),
                    min_size=0, max_size=6)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(facts=fact_rows, dims=dim_rows, salt=st.integers(2, 5))
def test_join_rewrites_equal_plain_join(spark, facts, dims, salt):
    from tidemark.operators.joins import unmatched_count, validity_join_count
    base = dt.date(2024, 1, 1)
    f = spark.createDataFrame([(k, base + dt.timedelta(days=d)) for k, d in facts], "person string, day date")
    d = spark.createDataFrame([(k, base + dt.timedelta(days=lo), base + dt.timedelta(days=lo + w))
                               for k, lo, w in dims], "off_id string, fra date, til date")
    plain = validity_join(f, d, "person", "off_id", "day", "fra", "til").count()
    assert validity_join_count(f, d, "person", "off_id", "day", "fra", "til").first()[0] == plain
    assert validity_join(f, d, "person", "off_id", "day", "fra", "til", salt=salt).count() == plain
    n_un = unmatched(f, d, "person", "off_id").count()
    assert unmatched_count(f, d, "person", "off_id").first()[0] == n_un
    assert unmatched(f, d, "person", "off_id", salt=salt).count() == n_un


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(minutes=st.lists(st.integers(0, 12 * 24 * 60), min_size=0, max_size=40),
       edge=st.booleans())
def test_recent_counts_equal_python(spark, minutes, edge):
    as_of = dt.datetime(2024, 1, 31)
    ts = [as_of - dt.timedelta(minutes=m) for m in minutes]
    if edge:   # values exactly on the bounds
        ts += [as_of - dt.timedelta(days=1), as_of - dt.timedelta(days=7), as_of - dt.timedelta(days=8)]
    df = spark.createDataFrame([(t,) for t in ts], "ts timestamp_ntz")
    r = recent_counts(df, "ts", as_of, {"d1": (1, True), "d7": (7, True), "d8x": (8, False)}).first()
    want = (sum(t >= as_of - dt.timedelta(days=1) for t in ts),
            sum(t >= as_of - dt.timedelta(days=7) for t in ts),
            sum(t > as_of - dt.timedelta(days=8) for t in ts))
    assert tuple(r) == want


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti", "right", "full"])
def test_salt_never_changes_a_join(spark, how):
    import datetime as dt
    from tidemark.operators.joins import validity_join
    day = dt.date(2024, 1, 5)
    facts = spark.createDataFrame([(1, day), (1, day), (2, day), (None, day)], "k long, day date")
    dim = spark.createDataFrame([(1, dt.date(2024, 1, 1), dt.date(2024, 2, 1)), (3, day, day)], "d long, f date, t date")
    args = (facts, dim, "k", "d", "day", "f", "t", how)
    if how in ("right", "full"):
        with pytest.raises(ValueError):
            validity_join(*args, salt=4)
        return
    plain, salted = validity_join(*args), validity_join(*args, salt=4)
    assert plain.columns == salted.columns
    assert sorted(map(str, plain.collect())) == sorted(map(str, salted.collect()))

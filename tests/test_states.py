"""Joins with many intervals per key, and distinct counts that merge."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.distinct_state import count_sets, daily_sets, distinct_between, update_distinct_state
from tidemark.operators.joins import SPAN, binned, validity_join, validity_join_binned
from tidemark.session import work_dir

D0 = dt.date(2020, 1, 1)
FACTS, DIM = "k string, day date, id int, _extra int", "off string, lo date, hi date, code int, _extra int"


def _sides(spark, seed, n=120):
    r = random.Random(seed)
    day = lambda: D0 + dt.timedelta(days=r.randint(-800, 800))
    facts = [(r.choice(["a", "b", None]), r.choice([day(), day(), None]), i, 1) for i in range(n)]
    dim = []
    for i in range(n):
        lo = day()
        hi = r.choice([lo, lo + dt.timedelta(days=r.randint(-3, 40)), lo + dt.timedelta(days=r.randint(0, 3000)), dt.date(9999, 12, 31), None])
        dim.append((r.choice(["a", "b", "c", None]), r.choice([lo, lo, lo, None, dt.date(1, 1, 1)]), hi, i, 2))
    return spark.createDataFrame(facts, FACTS), spark.createDataFrame(dim, DIM)


@pytest.mark.parametrize("seed,bin_days,salt", [(0, 7, 1), (1, 1, 1), (2, 30, 3), (3, 4000, 1)])
def test_binned_join_equals_the_plain_one(spark, seed, bin_days, salt):
    facts, dim = _sides(spark, seed)
    args = (facts, dim, "k", "off", "day", "lo", "hi")
    want, got = validity_join(*args), validity_join_binned(*args, bin_days=bin_days, salt=salt)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    _, cut = binned(facts, dim, "day", "lo", "hi", bin_days)
    assert cut.groupBy("code").count().agg(F.max("count")).first()[0] <= SPAN + 1


def test_work_follows_facts_and_matches(spark):
    """One key with 3,000 intervals of a day or two and 3,000 facts: nine million pairs in the plain join."""
    days = spark.range(3000).selectExpr("'a' AS k", "date_add(DATE '2015-01-01', CAST(id AS INT)) AS day", "id")
    dim = days.selectExpr("k AS off", "day AS lo", "date_add(day, CAST(id % 2 AS INT)) AS hi", "CAST(id AS INT) AS code")
    f, d = binned(days, dim, "day", "lo", "hi")
    pairs = f.alias("f").join(d.alias("d"), (F.col("f.k") == F.col("d.off")) & (F.col("f._level") == F.col("d._level"))
                              & (F.col("f._bin") == F.col("d._bin"))).count()
    matches = validity_join_binned(days, dim, "k", "off", "day", "lo", "hi").count()
    assert matches == 4499 and pairs < 9 * (3000 + matches)


def test_short_intervals_are_met_on_their_days_only(spark):
    days = spark.range(300).selectExpr("'a' AS k", "date_add(DATE '2015-01-01', CAST(id % 60 AS INT)) AS day", "id")
    dim = days.selectExpr("k AS off", "day AS lo", "date_add(day, CAST(id % 5 AS INT)) AS hi", "CAST(id AS INT) AS code")
    f, d = binned(days, dim, "day", "lo", "hi")
    on = [F.col(f"f.{c}") == F.col(f"d.{c}") for c in ("_level", "_bin")]
    pairs = f.alias("f").join(d.alias("d"), on[0] & on[1]).count()
    assert pairs == validity_join_binned(days, dim, "k", "off", "day", "lo", "hi").count() > 300


def test_no_interval_or_fact(spark):
    facts, dim = _sides(spark, 9)
    assert validity_join_binned(facts, dim.limit(0), "k", "off", "day", "lo", "hi").collect() == []
    assert validity_join_binned(facts.limit(0), dim, "k", "off", "day", "lo", "hi").collect() == []


@pytest.mark.parametrize("seed", range(3))
def test_daily_sets_give_exact_counts(spark, seed):
    r, path = random.Random(seed), work_dir(spark, "t-distinct")
    ids = [0, 1, -1, 32_768, 32_769, 10**12, -(10**9), None, *range(100, 130)]
    rows = [(r.choice(["x", "y", None]), r.choice([D0 + dt.timedelta(days=r.randint(0, 9)), None]), r.choice(ids)) for _ in range(300)]
    schema = "g string, day date, id long"
    whole = spark.createDataFrame(rows, schema)
    for k in (0, 1, 2, 1):
        update_distinct_state(spark, path, spark.createDataFrame(rows[k * 100:k * 100 + 130], schema), "day", "id", ["g"])
    update_distinct_state(spark, path, whole.limit(0), "day", "id", ["g"])
    for a, b in ((0, 6), (3, 3), (0, 9), (20, 30)):
        lo, hi = D0 + dt.timedelta(days=a), D0 + dt.timedelta(days=b)
        own = whole.where(F.col("day").between(lo, hi))
        want = own.where("id IS NOT NULL").groupBy("g").agg(F.count_distinct("id").alias("n_distinct"))
        got = distinct_between(spark, path, whole, lo, hi, ["g"])
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    total = count_sets(daily_sets(whole, "day", "id")).first()[0]
    assert total == whole.where("day IS NOT NULL").select("id").dropna().distinct().count()
    assert count_sets(daily_sets(whole.limit(0), "day", "id")).first()[0] == 0

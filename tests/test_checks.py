"""Several checks in one scan equal each check by itself; slices, splits and one-pass reconciliation."""

import datetime as dt
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.operators.gaps import gap_count
from tidemark.operators.joins import new_values, not_in_values
from tidemark.operators.reconcile import reconcile, reconcile_subset
from tidemark.operators.slices import late_messages, mark_slice
from tidemark.plans import catalog
from tidemark.plans.checks import GapCheck, Tagged, domain_counts, gap_counts, tagged_rows
from tidemark.session import work_dir
from tidemark.sources.tables import split_points, split_predicates
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("seed", range(3))
def test_gap_checks_in_one_scan(spark, seed):
    r = random.Random(seed)
    rows = [(r.choice(["a", "b", None]), r.choice([r.randint(0, 300), None]), r.choice(["x", "y", None]), r.randint(0, 9))
            for _ in range(300)] * 2
    df = spark.createDataFrame(rows, "topic string, o long, kind string, at int").repartition(3)
    x = F.col("kind") == "x"
    checks = {"all": GapCheck(), "floor": GapCheck(offset_floor=100, min_gap=2), "kind x": GapCheck(x, 50),
              "late": GapCheck(after=F.col("at") > 4)}
    got = gap_counts(df, "o", ["topic"], checks, carry="at", bucket_width=16).first().asDict()
    want = {"all": gap_count(df, "o", "topic"), "floor": gap_count(df, "o", "topic", min_gap=2, offset_floor=100),
            "kind x": gap_count(df.where(x), "o", "topic", offset_floor=50),
            "late": gap_count(df, "o", "topic", carry="at", after=F.col("at") > 4)}
    assert got == {k: v.first()[0] for k, v in want.items()}
    assert gap_counts(df.limit(0), "o", ["topic"], checks, carry="at").first().asDict() == dict.fromkeys(checks, 0)


@pytest.mark.parametrize("nulls,empty", [(False, False), (True, False), (False, True)])
def test_domain_checks_in_one_join(spark, nulls, empty):
    sold = [] if empty else [(1,), (2,), (2,), (None,)] if nulls else [(1,), (2,), (2,)]
    left, right = spark.createDataFrame(sold, "k long"), spark.createDataFrame([(1,), (3,), (None,), (4,), (4,)], "k long")
    x, y = (tagged_rows(d, {"t": Tagged(F.col("k"))}, "int") for d in (left, right))
    row = domain_counts(x, y, {"new": "t"}, {"back": "t"}, {"not_in": "t"}, {}).first()
    assert row["new"] == new_values(right, "k", left, "k").count()
    assert row["back"] == new_values(left, "k", right, "k").count()
    assert row["not_in"] == not_in_values(right, "k", left, "k").count()


@pytest.mark.parametrize("key,tables", [
    ("gap_alert", {"events": 1, "lineitem": 1}), ("gap_list", {"events": 1}), ("reconcile_diff", {"lineitem": 1}),
    ("weekly_report", {"events": 1, "customer": 1, "lineitem": 1, "part": 1, "supplier": 1, "orders": 1})])
def test_each_table_is_read_once(spark, key, tables):
    df = catalog.QUERIES[key](spark, SF_SMALL)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert Counter(re.findall(r"FileScan parquet.*?/(\w+)\.parquet", plan)) == tables


def test_one_pass_reconciliation(spark):
    r = random.Random(4)
    rows = [(r.choice(["p", "q", None]), r.choice(["A", "B", None]), r.choice([1, 2, 3, 4, None]), r.choice([True, False, None]))
            for _ in range(60)] + [("z", "A", 1, False)]
    df = spark.createDataFrame(rows, "period string, status string, id int, flag boolean")
    left = df.groupBy("period", "status").agg(F.count_distinct("id").alias("n_distinct"))
    right = df.where("flag").groupBy("period").agg(F.count_distinct("id").alias("n_distinct"))
    want = reconcile(left, right, ["period"], "n_distinct", "n_distinct")
    got = reconcile_subset(df, ["period"], ["status"], "id", "flag")
    assert sorted(map(tuple, got.select(*want.columns).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


ENV = "kafka_topic string, kafka_offset long, kafka_timestamp long, kafka_partition int"


def test_late_messages(spark):
    path, hour = work_dir(spark, "t-marks"), 3_600_000
    first = [("t", 1, 10, 0), ("t", 2, hour + 5, 0), ("t", 1, 20, 1), ("u", 9, 10, 0)]
    env = spark.createDataFrame(first, ENV)
    mark_slice(spark, path, "t", env, 0, hour)
    mark_slice(spark, path, "t", env, hour, 3 * hour)
    late = [("t", 5, 30, 0), ("t", 7, 2 * hour, 1), ("t", 3, 40, 2)]
    on_time = [("t", 6, 3 * hour, 0), ("u", 10, 30, 0), ("t", 0, 50, 1)]
    now = spark.createDataFrame(first + late + on_time, ENV).withColumn("high", F.lit(1))
    mark_slice(spark, path, "t", now, 0, hour)  # a slice that runs again keeps its first marks
    got = late_messages(spark, path, now)
    assert got.columns == [*now.columns, "start_ms", "stop_ms"]
    assert sorted(tuple(x)[:4] for x in got.collect()) == sorted(late)


@pytest.mark.parametrize("kind", ["even", "skewed", "text", "date", "one value", "empty"])
def test_splits_take_every_row_once_and_are_even(spark, kind):
    r = random.Random(2)
    values = {"even": list(range(2000)), "skewed": [7] * 900 + [r.randint(0, 9) for _ in range(100)] + [int(10 ** r.uniform(0, 9)) for _ in range(1000)],
              "text": [r.choice("abc") + "'" + str(r.randint(0, 500)) for _ in range(1500)], "one value": [5] * 50, "empty": [],
              "date": [dt.date(2020, 1, 1) + dt.timedelta(days=int(r.expovariate(0.01))) for _ in range(1500)]}[kind]
    t = {"text": "string", "date": "date"}.get(kind, "long")
    df = spark.createDataFrame([(v,) for v in values] + [(None,)] * 30, f"k {t}").repartition(4)
    points = split_points(df, "k", 8)
    preds = split_predicates("k", points)
    counts = df.agg(*[F.count_if(F.expr(p)).alias(str(i)) for i, p in enumerate(preds)]).first()
    assert sum(counts) == df.count() and counts[len(preds) - 1] == 30
    met = df.select(sum((F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in preds), F.lit(0)).alias("n"))
    assert met.where("n <> 1").count() == 0
    most = Counter(values).most_common(1)[0][1] if values else 0
    assert max([0, *counts[:-1]]) <= max(most, 2 * len(values) / 8 + 1)
    assert len(points) <= 3 * 8

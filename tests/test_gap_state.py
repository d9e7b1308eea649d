"""Gaps kept as a state equal the gaps of all messages; versions switch in one step."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import gap_state
from tidemark.operators.gap_state import offset_runs, state_gaps, update_gap_state
from tidemark.operators.gaps import offset_gaps_lead
from tidemark.session import work_dir
from tidemark.sources import versions
from tidemark.sources.versions import Changed, current, publish, read_version, write_cells, write_files

SCHEMA = "topic string, part int, o long, at int"


def _sorted(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("seed", range(4))
def test_any_split_into_batches_gives_the_gaps_of_all(spark, seed):
    r = random.Random(seed)
    rows = [(r.choice(["a", "b", None]), r.randint(0, 1), r.choice([r.randint(0, 60), r.randint(500, 900), None, r.randint(-9, 3)]),
             r.randint(0, 9)) for _ in range(250)]
    batches = [[] for _ in range(4)]
    for x in rows:  # out of order, some in several batches
        for k in r.sample(range(4), r.choice([1, 1, 1, 2])):
            batches[k].append(x)
    path, width = work_dir(spark, "t-gaps"), r.choice([1, 7, 64, 1 << 20])
    by, seen = ["topic", "part"], []
    for k, b in enumerate([*batches, batches[0], []]):
        seen += b
        update_gap_state(spark, path, spark.createDataFrame(b, SCHEMA), "o", by, "at", width)
        if k in (1, 5):
            whole = spark.createDataFrame(seen, SCHEMA)
            full = whole.where("o IS NOT NULL").groupBy(*by, "o").agg(F.max("at").alias("at"))
            want = offset_gaps_lead(full, "o", by, carry="at")
            got = state_gaps(spark, path, whole, by, carry="at")
            assert _sorted(got.select(*want.columns)) == _sorted(want)
            want = offset_gaps_lead(full, "o", by, min_gap=5, offset_floor=20)
            assert _sorted(state_gaps(spark, path, whole, by, 5, 20).select(*want.columns)) == _sorted(want)


def test_a_batch_reads_its_own_cells(spark, monkeypatch):
    path, asked, real = work_dir(spark, "t-cells"), [], gap_state.read_version

    def spy(spark_, p, schema, cells=None, version=None):
        asked.append(cells)
        return real(spark_, p, schema, cells, version)

    monkeypatch.setattr(gap_state, "read_version", spy)
    for lo in range(0, 4000, 1000):
        df = spark.range(lo, lo + 1000).selectExpr("'t' AS topic", "id AS o")
        update_gap_state(spark, path, df, "o", ["topic"], bucket_width=1000)
    assert all(len(c) == 1 for c in asked)
    state = real(spark, path, "topic string, bucket bigint, lo bigint, hi bigint")
    assert sorted((x.lo, x.hi) for x in state.collect()) == [(k, k + 999) for k in range(0, 4000, 1000)]
    assert state_gaps(spark, path, df, ["topic"]).collect() == []


def test_runs_follow_gaps_not_rows(spark):
    df = spark.range(0, 100_000).selectExpr("'t' AS topic", "id AS o").where("o % 40000 <> 39999")
    runs = offset_runs(df.unionByName(df), "o", ["topic"])
    assert sorted((x.lo, x.hi) for x in runs.collect()) == [(0, 39998), (40000, 79998), (80000, 99999)]


# ---------------------------------------------------------------- versions

def test_readers_keep_their_version_and_a_stop_changes_nothing(spark, monkeypatch):
    path = work_dir(spark, "t-versions")
    numbers = lambda lo, hi: spark.range(lo, hi).selectExpr("id", "CAST(id % 2 AS STRING) AS cell")
    v1 = publish(spark, path, current(spark, path), write_cells(numbers(0, 10), path, "cell"))
    reader = read_version(spark, path, "id long")
    cells = write_cells(numbers(10, 30), path, "cell")
    assert sorted(x.id for x in read_version(spark, path, "id long").collect()) == list(range(10))
    with monkeypatch.context() as m:
        m.setattr(versions, "rename_path", lambda *a: (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(OSError):
            publish(spark, path, v1, cells)
    assert current(spark, path).number == 1
    v2 = publish(spark, path, v1, {**v1.cells, "1": cells["1"]}, "run-2")
    assert (v2.number, v2.run) == (2, "run-2")
    assert sorted(x.id for x in reader.collect()) == list(range(10))
    assert sorted(x.id for x in read_version(spark, path, "id long").collect()) == [0, 2, 4, 6, 8, *range(11, 30, 2)]
    assert sorted(x.id for x in read_version(spark, path, "id long", ["1"]).collect()) == list(range(11, 30, 2))
    with pytest.raises(Changed):
        publish(spark, path, v1, cells)
    for _ in range(versions.KEEP + 1):
        v2 = publish(spark, path, v2, {"all": write_files(numbers(0, 3), path)})
    assert len(versions._numbers(spark, path)) == versions.KEEP
    assert sorted(x.id for x in read_version(spark, path, "id long").collect()) == [0, 1, 2]

"""Appends that happen once, the index of a landing table's files, and the unpack stage."""

import json
import random

import pytest
from pyarrow.parquet import ParquetFile
from pyspark.sql import functions as F

from tidemark.operators import landing
from tidemark.operators.ingest import IngestSpec, ingest_batch, skip_duplicates
from tidemark.operators.landing import (Run, append_once, appended, candidate_files, finish_appends, index_table,
                                        read_index, read_landing)
from tidemark.plans import landing_queries as q
from tidemark.session import list_names, work_dir
from tidemark.sources.tables import stream_table
from tidemark.streaming.ingest import query_id, run_ingest
from tidemark.streaming.unpack import UnpackSpec, rejected_rows, run_unpack, typed_rows, unpack

KEYS = ["kafka_topic", "kafka_offset"]
SCHEMA = "kafka_topic string, kafka_offset long, melding string"


def _rows(spark, topics, offsets):
    return spark.createDataFrame([(t, o, f"{t}{o}") for t in topics for o in offsets], SCHEMA)


def _land(df, target, run):
    return append_once(df, target, run, ["kafka_topic"], KEYS, "kafka_offset", "kafka_topic")


def _all(spark, target):
    return sorted((r[0] or "", r[1] or 0, r[2]) for r in read_landing(spark, target, SCHEMA).collect())


class Stop(Exception):
    pass


def _stop(*args, **kwargs):
    raise Stop


STOPS = ["_index", "write_text", "_publish", "rename_path"]


@pytest.mark.parametrize("where", STOPS)
@pytest.mark.parametrize("repeat", [True, False])
def test_a_run_that_stops_appends_once(spark, monkeypatch, where, repeat):
    target = work_dir(spark, "t-stop")
    _land(_rows(spark, "ab", range(5)), target, Run("s", 0))
    before = _all(spark, target)
    new = _rows(spark, "ab/c", range(5, 9))
    with monkeypatch.context() as m:
        if where == "rename_path":  # stops after the first file was moved
            moved, real = [], landing.rename_path

            def first_only(spark_, a, b):
                if moved:
                    raise Stop
                moved.append(a)
                real(spark_, a, b)

            m.setattr(landing, where, first_only)
        else:
            m.setattr(landing, where, _stop)
        with pytest.raises(Stop):
            _land(new, target, Run("s", 1))
    decided = where in ("_publish", "rename_path")
    if not repeat:
        assert len(_all(spark, target)) == len(before) + (16 if decided else 0)
        return
    again = _rows(spark, "ab/c", range(5, 9)) if not decided else _rows(spark, "z", range(99))
    out = _land(again, target, Run("s", 1))  # a decided run keeps its own rows
    assert sorted(r.kafka_offset for r in out.collect()) == sorted([5, 6, 7, 8] * 4)
    assert _all(spark, target) == sorted(before + [(t, o, f"{t}{o}") for t in "ab/c" for o in range(5, 9)])
    assert len(candidate_files(spark, target, _rows(spark, "c", [5]), KEYS, "kafka_offset", "kafka_topic")) >= 1


def test_runs_of_several_writers_do_not_mix(spark):
    target = work_dir(spark, "t-writers")
    a = _land(_rows(spark, "a", range(3)), target, Run("one", 0))
    b = _land(_rows(spark, "b", range(4)), target, Run("two", 0))
    assert (a.count(), b.count()) == (3, 4)
    assert appended(spark, target, Run("one", 0), a.schema).count() == 3
    assert appended(spark, target, Run("one", 1), a.schema) is None
    assert spark.read.parquet(target).count() == 7  # readers without the library see the rows alone


def test_old_entries_go(spark, monkeypatch):
    monkeypatch.setattr(landing, "KEEP", 2)
    target = work_dir(spark, "t-keep")
    for n in range(4):
        append_once(_rows(spark, "a", [n]), target, Run("s", n))
    append_once(_rows(spark, "a", [9]), target, Run.once())
    names = [n for w in ("s", landing.ONCE) for n, _ in list_names(spark, f"{target}/_ledger/{w}") if "crc" not in n]
    assert sorted(names) == ["2.done", "3.done"]
    assert read_landing(spark, target, SCHEMA).count() == 5


@pytest.mark.parametrize("probe_from", [0, 1 << 30])
@pytest.mark.parametrize("seed", range(3))
def test_only_files_that_may_hold_a_key_are_read(spark, monkeypatch, probe_from, seed):
    monkeypatch.setattr(landing, "PROBE_FROM", probe_from)
    r, target = random.Random(seed), work_dir(spark, "t-index")
    held = set()
    for n in range(5):
        own = {(r.choice("abc"), r.randint(n * 9000, n * 9000 + 9500)) for _ in range(60)}
        held |= own
        df = spark.createDataFrame([(t, o, "m") for t, o in own] + [(None, 5, "m"), ("a", None, "m")], SCHEMA)
        _land(df.coalesce(2), target, Run("s", n))
    asked = {(r.choice("abcd"), r.randint(0, 50_000)) for _ in range(30)} | set(r.sample(sorted(held), 12))
    batch = spark.createDataFrame([(t, o, "m") for t, o in asked] + [(None, 5, "m")], SCHEMA)
    files = candidate_files(spark, target, batch, KEYS, "kafka_offset", "kafka_topic")
    whole, some = (read_landing(spark, target, SCHEMA, f) for f in (None, files))
    want = sorted(map(tuple, skip_duplicates(batch, whole, KEYS).select(*KEYS).collect()), key=str)
    assert sorted(map(tuple, skip_duplicates(batch, some, KEYS, offset_col=None).select(*KEYS).collect()), key=str) == want
    assert len(want) == len(asked - held) + 1
    one = spark.createDataFrame([(*sorted(held)[0], "m")], SCHEMA)
    few = candidate_files(spark, target, one, KEYS, "kafka_offset", "kafka_topic")
    assert 1 <= len(few) <= 3 < len(whole.inputFiles())
    none = spark.createDataFrame([("a", 10**9, "m"), (None, 1, "m")], SCHEMA)
    assert candidate_files(spark, target, none, KEYS, "kafka_offset", "kafka_topic") == []


def test_filter_has_several_bit_maps_and_no_false_negative(spark, monkeypatch):
    monkeypatch.setattr(landing, "PROBE_FROM", 0)
    target = work_dir(spark, "t-bloom")
    df = spark.range(0, 40_000, 2).selectExpr("'a' AS kafka_topic", "id AS kafka_offset", "'m' AS melding")
    _land(df.coalesce(1), target, Run("s", 0))
    index = read_index(spark, target, df, KEYS)
    assert index.where("part IS NOT NULL").select("part").distinct().count() > 4
    every = candidate_files(spark, target, df, KEYS, "kafka_offset", "kafka_topic")
    assert len(every) == 1
    odd = [spark.createDataFrame([("a", o, "m")], SCHEMA) for o in (1, 101, 20_001, 39_997)]
    hits = [len(candidate_files(spark, target, d, KEYS, "kafka_offset", "kafka_topic")) for d in odd]
    assert sum(hits) <= 1  # ten bits a key: about one in a hundred by chance


def test_index_is_made_without_sorting_or_gathering_the_keys(spark):
    target = f"{work_dir(spark, 't-plan')}"
    rows = spark.range(30_000).selectExpr("if(id % 3 = 0, 'a', 'b') AS kafka_topic", "if(id % 7 = 0, null, id) AS kafka_offset", "'m' AS melding")
    rows.repartition(2).write.partitionBy("kafka_topic").parquet(target)
    landed = spark.read.schema(SCHEMA).parquet(target)
    index = landing._index(landed, target, KEYS, "kafka_offset", "kafka_topic")
    plan = index._jdf.queryExecution().executedPlan().toString()
    assert not any(step in plan for step in ("Coalesce", "Window", "SortAggregate", "SinglePartition"))
    # the bit maps are the ones that Spark's own aggregate makes of the same places
    name = F.regexp_extract("_metadata.file_path", f"{target}/(.*)$", 1)
    sizes = index.where("part IS NOT NULL").select("file", "bits").distinct()
    place = F.col("place") + 1
    want = (landed.select(name.alias("file"), *KEYS).dropna().join(sizes, "file")
            .select("file", "bits", F.explode(landing._places(KEYS, F.col("bits"))).alias("place"))
            .groupBy("file", "bits", F.bitmap_bucket_number(place).alias("part"))
            .agg(F.hex(F.bitmap_construct_agg(F.bitmap_bit_position(place))).alias("map")))
    got = index.where("part IS NOT NULL").select("file", "bits", "part", F.hex("map").alias("map"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() > 8
    n = index.where("part IS NULL").agg(F.sum("n"), F.min("lo"), F.max("hi")).first()
    assert tuple(n) == (landed.dropna(subset=KEYS).count(), 1, 29_999)


def test_index_of_other_keys_or_an_older_table_is_not_used(spark):
    target = work_dir(spark, "t-old")
    _rows(spark, "ab", range(5)).write.partitionBy("kafka_topic").parquet(target)
    _land(_rows(spark, "ab", range(5, 7)), target, Run("s", 0))
    batch = _rows(spark, "a", [3])
    assert candidate_files(spark, target, batch, KEYS, "kafka_offset", "kafka_topic") is None
    index_table(spark, target, SCHEMA, KEYS, "kafka_offset", "kafka_topic")
    assert len(candidate_files(spark, target, batch, KEYS, "kafka_offset", "kafka_topic")) >= 1
    assert candidate_files(spark, target, batch, ["kafka_offset"], "kafka_offset") is None
    append_once(_rows(spark, "a", [50]), target, Run("s", 1), ["kafka_topic"], ["kafka_offset"], "kafka_offset")
    assert candidate_files(spark, target, batch, KEYS, "kafka_offset", "kafka_topic") is None


def test_message_files_can_be_read_by_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(q, "ROW_GROUP", 1 << 15)
    events = spark.range(20_000).selectExpr(
        "id AS event_id", "timestamp_ntz '2024-01-01' + make_dt_interval(cast(id % 30 AS int)) AS ts", "id % 9 AS user_id",
        "'a' AS event_type", "1.0D AS value", "sha2(string(id), 256) AS props")
    folder = q.message_files(spark, events)
    files = [n for n, _ in list_names(spark, folder) if n.endswith(".parquet")]
    groups = [ParquetFile(f"{folder.removeprefix('file:')}/{n}").num_row_groups for n in files]
    assert len(files) == q.FILES and min(groups) > 1
    assert spark.read.parquet(folder).count() == 22_000


ENV = "kafka_message string, kafka_topic string, kafka_offset long, kafka_timestamp long, kafka_partition int"
SPEC = {"source": {"topic": "t"}, "target": {"table": "x"}, "transform": [
    {"src": "kafka_message", "dst": "melding"}, {"src": "kafka_topic", "dst": "kafka_topic"},
    {"src": "kafka_offset", "dst": "kafka_offset"}, {"src": "kafka_partition", "dst": "kafka_partition"}]}


@pytest.mark.parametrize("keys", [[], ["kafka_topic", "kafka_offset"]])
def test_stream_without_keys_lands_each_batch_once(spark, monkeypatch, keys):
    src, target, ckpt = (work_dir(spark, n) for n in ("k-src", "k-target", "k-ckpt"))
    for n in range(4):
        rows = [(f"m{n}{i}", "t", n * 10 + i if i else None, 0, 0) for i in range(5)]
        spark.createDataFrame(rows, ENV).coalesce(1).write.mode("append").parquet(src)
    spec = IngestSpec.from_dict({**SPEC, "target": {"table": "x", "skip-duplicates-with": keys}})

    def run():
        stream = stream_table(spark, src, spark.createDataFrame([], ENV).schema, max_files_per_trigger=1)
        run_ingest(stream, spec, target, ckpt, timeout_s=300)

    import tidemark.operators.ingest as ingest
    calls, real = [], ingest.append_once

    def fails_after_the_append(*a, **k):
        real(*a, **k)
        calls.append(1)
        if len(calls) in (1, 3):
            raise Stop

    with monkeypatch.context() as m:
        m.setattr(ingest, "append_once", fails_after_the_append)
        for _ in range(2):
            with pytest.raises(Exception):
                run()
    run()
    run()
    landed = sorted(r.melding for r in spark.read.parquet(target).collect())
    assert landed == sorted(f"m{n}{i}" for n in range(4) for i in range(5))
    assert len(query_id(spark, ckpt)) == 36


def test_batches_of_a_stream_and_redelivered_messages(spark):
    df = q.q_stream_ingest(spark, "/root/testdata/sf0.001")
    assert df.count() == df.select("kafka_offset").distinct().count() == 1000


# ---------------------------------------------------------------- unpack

PAYLOAD = UnpackSpec("id bigint, at string, lines array<struct<n: int>>",
                     {"id": "id", "at": "to_date(at)", "n": "element.n"}, ("id", "n"), "lines", keep=("kafka_offset",))


def test_reasons(spark):
    texts = {1: '{"id":1,"at":"2024-01-05","lines":[{"n":1},{"n":2}]}', 2: '{"id":"x","lines":[]}', 3: '{"id":1,"li', 4: None,
             5: " ", 6: '{"lines":[{"n":2}]}', 7: '{"id":1}', 8: '{"id":1,"lines":[]}', 9: "[1]", 10: "5",
             11: '{"id":1,"lines":[null,{"n":"3"}]}', 12: '{"id":1,"lines":[null,{"n":3}],"more":{"x":1}}', 13: '{"id":null,"lines":[]}'}
    df = spark.createDataFrame(list(texts.items()), "kafka_offset long, melding string").withColumn("position", F.lit("x"))
    rows = unpack(df, PAYLOAD)
    assert sorted((r.kafka_offset, r.position, r.id, str(r["at"]), r.n) for r in typed_rows(rows).collect()) == [
        (1, 0, 1, "2024-01-05", 1), (1, 1, 1, "2024-01-05", 2), (12, 1, 1, "None", 3)]
    bad = {(r.kafka_offset, r.position): r.reason for r in rejected_rows(rows, PAYLOAD).collect()}
    no = "does not fit the schema"
    assert bad == {(2, None): no, (3, None): no, (4, None): "no message", (5, None): "no message", (6, 0): "missing id",
                   (7, None): "missing lines", (9, None): no, (10, None): no, (11, None): no, (12, 0): "missing n"}
    flat = UnpackSpec("id bigint", {"id": "id"}, keep=("kafka_offset",), message="melding")
    assert typed_rows(unpack(df, flat)).where("id = 1").count() == 5
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_stages_stop_and_go_on_by_themselves(spark, monkeypatch):
    """Landing runs, stops, runs on; the unpack stage fails between its two tables and goes on."""
    src, landing_path, typed, rejected, c1, c2 = (work_dir(spark, n) for n in ("u1", "u2", "u3", "u4", "u5", "u6"))
    spec = IngestSpec.from_dict({**SPEC, "target": {"table": "x", "skip-duplicates-with": ["kafka_topic", "kafka_offset"]}})
    out = "melding string, kafka_topic string, kafka_offset long, kafka_partition int"
    schema = spark.createDataFrame([], out).schema

    def deliver(*offsets):
        rows = [(json.dumps({"id": o if o % 4 else None, "lines": [{"n": k} for k in range(o % 3 + 1)]}), "t", o, 0, 0) for o in offsets]
        spark.createDataFrame(rows, ENV).coalesce(1).write.mode("append").parquet(src)

    def land():
        stream = stream_table(spark, src, spark.createDataFrame([], ENV).schema, max_files_per_trigger=1)
        run_ingest(stream, spec, landing_path, c1, timeout_s=300)

    def second():
        run_unpack(spark, landing_path, schema, PAYLOAD, typed, rejected, c2, max_files_per_trigger=1, timeout_s=300)

    def check(offsets):
        got = sorted((r.kafka_offset, r.position) for r in spark.read.parquet(typed).collect())
        assert got == sorted((o, k) for o in offsets if o % 4 for k in range(o % 3 + 1))
        assert sorted(r.kafka_offset for r in spark.read.parquet(rejected).collect()) == sorted(
            o for o in offsets if o % 4 == 0 for _ in range(o % 3 + 1))

    deliver(1, 2, 3)
    deliver(3, 4, 5)
    deliver(6, 8)
    land()
    second()
    check([1, 2, 3, 4, 5, 6, 8])
    deliver(1, 9, 12)
    deliver(16, 17)
    land()  # the stages are apart: nothing is unpacked yet
    check([1, 2, 3, 4, 5, 6, 8])
    import tidemark.streaming.unpack as u
    real, calls = u.append_once, []

    def between(*a, **k):
        calls.append(1)
        if len(calls) == 2:
            raise Stop
        return real(*a, **k)

    with monkeypatch.context() as m:
        m.setattr(u, "append_once", between)
        with pytest.raises(Exception):
            second()
    second()
    check([1, 2, 3, 4, 5, 6, 8, 9, 12, 16, 17])
    assert len([n for n, _ in list_names(spark, f"{c2}/commits") if n.isdigit()]) >= 3
    finish_appends(spark, landing_path)


# ---------------------------------------------------------------- specs

@pytest.mark.parametrize("dst,name,value,want", [
    ("melding", "melding", "oracledb.DB_TYPE_BLOB", "binary"), ("kafka_message", "kafka_message", "oracledb.BLOB", "binary"),
    ("melding", "melding", "oracledb.DB_TYPE_CLOB", "string"), ("melding", "other", "oracledb.BLOB", "string")])
def test_payload_column_is_bound_by_its_own_name(spark, dst, name, value, want):
    spec = IngestSpec.from_dict({"source": {"topic": "t"}, "transform": [{"src": "kafka_message", "dst": dst}],
                                 "target": {"table": "x", "custom-config": [{"name": name, "value": value}]}})
    assert spec.message_type == want
    out = ingest_batch(spark, spec, spark.createDataFrame([("æ", "t", 1, 0, 0)], ENV), work_dir(spark, "t-blob"), run=Run("a", 1))
    assert dict(out.dtypes)[dst] == want and bytes(out.select(F.col(dst).cast("binary")).first()[0]) == "æ".encode()

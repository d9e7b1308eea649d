"""Config-driven ingest: spec lowering, duplicate skipping, replay, streaming."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators.ingest import IngestSpec, apply_spec, ingest_batch, skip_duplicates
from tidemark.session import work_dir
from tidemark.streaming import run_ingest

SPEC_YAML = """
source:
  type: kafka
  batch-size: 100
  batch-interval: 5
  topic: {}
  group-id: test-group
  schema: json
  keypath-seperator: /
target:
  type: parquet
  skip-duplicates-with:
    - kafka_offset
    - kafka_topic
  table: landing
transform:
  - src: kafka_message
    dst: melding
  - src: kafka_topic
    dst: kafka_topic
  - src: kafka_offset
    dst: kafka_offset
  - src: kafka_timestamp
    dst: kafka_mottatt_dato
    fun: int-unix-ms -> datetime-no
  - src: kafka_partition
    dst: kafka_partisjon
  - src: $$$BATCH_TIME
    dst: lastet_dato
  - src: a/b
    dst: nested
  - src: typ
    dst: typ
  - src: $LITERAL
    dst: kind
"""

ENV_SCHEMA = ("kafka_message string, kafka_topic string, kafka_offset long, kafka_timestamp long, "
              "kafka_partition int")
BT = dt.datetime(2024, 5, 1, 12, 0)


def _env(spark, rows):
    return spark.createDataFrame(rows, ENV_SCHEMA)


def _msg(i, typ="X"):
    return json.dumps({"a": {"b": f"n{i}"}, "typ": typ})


def test_spec_lowering(spark):
    spec = IngestSpec.from_yaml(SPEC_YAML, topic="t1")
    assert spec.topic == "t1" and spec.batch_size == 100
    assert spec.dedupe_keys() == ["kafka_offset", "kafka_topic"]
    ms = int(dt.datetime(2024, 3, 31, 1, 0, tzinfo=dt.timezone.utc).timestamp() * 1000)
    df = apply_spec(_env(spark, [(_msg(1, "FP"), "t1", 5, ms, 0)]), spec, BT)
    r = df.first().asDict()
    assert df.columns == ["melding", "kafka_topic", "kafka_offset", "kafka_mottatt_dato",
                          "kafka_partisjon", "lastet_dato", "nested", "typ", "kind"]
    assert r["kafka_mottatt_dato"] == dt.datetime(2024, 3, 31, 3, 0)   # summer time in Oslo
    assert (r["lastet_dato"], r["nested"], r["typ"], r["kind"]) == (BT, "n1", "FP", "LITERAL")


def test_skip_duplicates_two_and_three_keys(spark):
    target = _env(spark, [("m", "t", 1, 0, 0)])
    incoming = _env(spark, [("m", "t", 1, 0, 1), ("m", "t", 2, 0, 0), ("m", "t", 2, 0, 0)])
    two = skip_duplicates(incoming, target, ["kafka_topic", "kafka_offset"])
    three = skip_duplicates(incoming, target, ["kafka_topic", "kafka_partition", "kafka_offset"])
    assert sorted(r["kafka_offset"] for r in two.collect()) == [2]
    # the three-key form keeps offset 1 of partition 1 (the two-key form loses it)
    assert sorted((r["kafka_partition"], r["kafka_offset"]) for r in three.collect()) == [(0, 2), (1, 1)]
    assert skip_duplicates(incoming, target, []).count() == 3


def test_ingest_replay_adds_nothing(spark):
    spec = IngestSpec.from_yaml(SPEC_YAML, topic="t")
    rows = [(_msg(i), "t", i, 1_700_000_000_000 + i, 0) for i in range(20)]
    target = work_dir(spark, "t-ingest")
    first = ingest_batch(spark, spec, _env(spark, rows[:12]), target, BT)
    assert first.count() == 12
    second = ingest_batch(spark, spec, _env(spark, rows[8:]), target, BT + dt.timedelta(hours=1))
    assert second.count() == 8
    again = ingest_batch(spark, spec, _env(spark, rows), target, BT + dt.timedelta(hours=2))
    assert again.count() == 0
    landed = spark.read.parquet(target)
    assert landed.count() == 20
    assert landed.select("kafka_offset").distinct().count() == 20


def test_stream_equals_batch(spark):
    spec = IngestSpec.from_yaml(SPEC_YAML, topic="t")
    src = work_dir(spark, "t-stream-src")
    rows = [(_msg(i), "t", i % 15, 1_700_000_000_000 + i, 0) for i in range(30)]  # repeats
    _env(spark, rows[:15]).write.parquet(src + "/a")
    _env(spark, rows[15:]).write.parquet(src + "/b")
    stream = (spark.readStream.schema(ENV_SCHEMA).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(src))
    target = work_dir(spark, "t-stream-target")
    ckpt = work_dir(spark, "t-stream-ckpt")
    run_ingest(stream, spec, target, ckpt, batch_time=lambda epoch: BT, timeout_s=300)
    landed = spark.read.parquet(target)
    batch = apply_spec(_env(spark, rows), spec, BT).dropDuplicates(["kafka_topic", "kafka_offset"])
    assert landed.count() == 15
    assert sorted(r["kafka_offset"] for r in landed.collect()) == \
        sorted(r["kafka_offset"] for r in batch.collect())
    # restart with the same checkpoint: nothing new
    run_ingest(stream, spec, target, ckpt, batch_time=BT, timeout_s=300)
    assert spark.read.parquet(target).count() == 15


def test_binary_message_spec(spark):
    spec = IngestSpec.from_dict({
        "source": {"topic": "{}"},
        "target": {"table": "x", "custom-config": [{"name": "melding", "value": "DB_TYPE_BLOB"}]},
        "transform": [{"src": "kafka_message", "dst": "melding"}],
    })
    df = apply_spec(_env(spark, [("abc", "t", 1, 0, 0)]), spec)
    assert dict(df.dtypes)["melding"] == "binary"
    assert df.select(F.col("melding").cast("string")).first()[0] == "abc"


def test_skip_duplicates_prunes_target_per_topic(spark):
    target = _env(spark, [("m", "a", 1, 0, 0), ("m", "a", 50, 0, 0), ("m", "b", 3, 0, 0)])
    incoming = _env(spark, [("m", "a", 50, 0, 0), ("m", "a", 51, 0, 0), ("m", "b", 3, 0, 0),
                            ("m", "c", 9, 0, 0), ("m", None, 4, 0, 0)])
    out = skip_duplicates(incoming, target, ["kafka_topic", "kafka_offset"])
    assert sorted((r["kafka_topic"] or "", r["kafka_offset"]) for r in out.collect()) == \
        [("", 4), ("a", 51), ("c", 9)]


def test_ingest_many_fan_in(spark):
    from tidemark.operators.ingest import ingest_many
    base = IngestSpec.from_yaml(SPEC_YAML)
    parts = []
    for topic, lit in (("t1", "ONE"), ("t2", "TWO")):
        tr = tuple(f if f.dst != "kind" else type(f)(f"${lit}", "kind") for f in base.transform)
        spec = IngestSpec(**{**base.__dict__, "transform": tr, "topic": topic})
        rows = [(_msg(i), topic, i, 1_700_000_000_000 + i, 0) for i in range(5)]
        parts.append((spec, _env(spark, rows + rows[:2])))   # repeats inside the batch
    target = work_dir(spark, "t-fan-in")
    assert ingest_many(spark, parts, target, BT).count() == 10
    assert ingest_many(spark, parts, target, BT).count() == 0
    landed = spark.read.parquet(target)
    assert sorted((r["kafka_topic"], r["kind"]) for r in landed.select("kafka_topic", "kind")
                  .distinct().collect()) == [("t1", "ONE"), ("t2", "TWO")]


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(offsets=st.lists(st.integers(0, 40), min_size=1, max_size=30),
       cuts=st.lists(st.tuples(st.integers(0, 29), st.integers(1, 30)), min_size=1, max_size=3))
def test_overlapping_slices_land_each_message_once(spark, offsets, cuts):
    spec = IngestSpec.from_yaml(SPEC_YAML, topic="t")
    rows = [(_msg(o), "t", o, 1_700_000_000_000 + o, 0) for o in offsets]
    target = work_dir(spark, "t-prop-ingest")
    for a, n in cuts:
        part = rows[a:a + n]
        if part:
            ingest_batch(spark, spec, _env(spark, part), target, BT)
    ingest_batch(spark, spec, _env(spark, rows), target, BT)   # final full replay
    landed = sorted(r["kafka_offset"] for r in spark.read.parquet(target).collect())
    assert landed == sorted(set(offsets))


def test_ingest_partitioned_by_numeric_looking_topic(spark):
    spec = IngestSpec.from_yaml(SPEC_YAML, topic="123")
    rows = [(_msg(i), "123", i, 1_700_000_000_000 + i, 0) for i in range(6)]
    target = work_dir(spark, "t-part-ingest")
    assert ingest_batch(spark, spec, _env(spark, rows[:4]), target, BT,
                        partition_by=["kafka_topic"]).count() == 4
    assert ingest_batch(spark, spec, _env(spark, rows), target, BT,
                        partition_by=["kafka_topic"]).count() == 2
    assert spark.read.parquet(target).count() == 6


def test_hash_pass_through_or_computed(spark):
    import hashlib
    spec = IngestSpec.from_dict({"source": {"topic": "t"}, "target": {"table": "x"},
                                 "transform": [{"src": "kafka_message", "dst": "melding"},
                                               {"src": "kafka_hash", "dst": "kafka_hash"}]})
    env = _env(spark, [('{"a": 1}', "t", 1, 0, 0)])
    computed = apply_spec(env, spec).first()["kafka_hash"]
    assert computed == hashlib.sha256(b'{"a": 1}').hexdigest()
    given = apply_spec(env.withColumn("kafka_hash", F.lit("h1")), spec).first()["kafka_hash"]
    assert given == "h1"


def test_unfilled_topic_placeholder():
    assert IngestSpec.from_yaml(SPEC_YAML).topic is None
    assert IngestSpec.from_yaml(SPEC_YAML.replace("topic: {}", "topic: fixed.topic")).topic == "fixed.topic"
    assert IngestSpec.from_yaml(SPEC_YAML, topic="x").topic == "x"


def test_rows_with_a_null_key_are_kept(spark):
    schema = "kafka_topic string, kafka_offset long, melding string"
    rows = [("t", None, "a"), ("t", None, "b"), ("t", 1, "c"), ("t", 1, "c"), (None, 1, "d")]
    out = skip_duplicates(spark.createDataFrame(rows, schema), None, ["kafka_topic", "kafka_offset"])
    assert sorted(r.melding for r in out.collect()) == ["a", "b", "c", "d"]
    target = spark.createDataFrame([("t", 1, "c"), ("t", None, "a")], schema)
    out = skip_duplicates(spark.createDataFrame(rows, schema), target, ["kafka_topic", "kafka_offset"])
    assert sorted(r.melding for r in out.collect()) == ["a", "b", "d"]


@pytest.mark.parametrize("topics", [1, 64, 65, 200])
def test_target_is_cut_alike_for_any_number_of_topics(spark, topics):
    keys = ["kafka_topic", "kafka_offset"]
    schema = "kafka_topic string, kafka_offset long"
    target = spark.createDataFrame([(f"t{t}", t * 1000 + o) for t in range(topics) for o in range(20)], schema)
    batch = spark.createDataFrame([(f"t{t}", t * 1000 + o) for t in range(topics) for o in (18, 19, 20)], schema)
    out = skip_duplicates(batch, target, keys)
    assert sorted(map(tuple, out.collect())) == sorted((f"t{t}", t * 1000 + 20) for t in range(topics))
    text = out._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("LeftSemi") == 1 and text.count("LeftAnti") == 1



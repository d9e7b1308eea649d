import pytest
"""Sources and sinks: table reads, CSV export / load, table copies, envelope slices."""

import datetime as dt
import os

from pyspark.sql import functions as F

from tidemark.operators.refresh import period_refresh, write_periodic
from tidemark.session import work_dir
from tidemark.sources import (copy_tables, export_csv, load_csv, read_table, slice_envelope,
                              table_as_envelope)
from tests.conftest import SF_SMALL


def test_read_table_columns_and_views(spark):
    df = read_table(spark, f"{SF_SMALL}/nation.parquet", ["n_name"])
    assert df.columns == ["n_name"] and df.count() == 25
    df.createOrReplaceTempView("nation_v")
    assert read_table(spark, "nation_v", fmt="table").count() == 25


def test_csv_single_file_export(spark):
    out = work_dir(spark, "t-csv")
    cnt = read_table(spark, f"{SF_SMALL}/customer.parquet").agg(F.count(F.lit(1)).alias("n"))
    export_csv(cnt, out, single_file=True)
    parts = [f for f in os.listdir(out.replace("file:", "")) if f.endswith(".csv")]
    assert len(parts) == 1
    back = load_csv(spark, out).collect()
    assert [tuple(r) for r in back] == [(150,)]


def test_copy_tables_list(spark):
    root = work_dir(spark, "t-copy")
    tables = [{"schema": "s1", "tabellnavn": "nation"},
              {"schema": "s1", "tabellnavn": "customer", "columns": ["c_custkey", "c_name"]}]
    out = copy_tables(spark, tables,
                      resolve=lambda s, t: read_table(spark, f"{SF_SMALL}/{t}.parquet"),
                      target=lambda s, t: f"{root}/{s}/{t}")
    assert out["s1.nation"].count() == 25
    assert out["s1.customer"].columns == ["c_custkey", "c_name"]
    # a second run replaces, it does not append
    out2 = copy_tables(spark, tables[:1],
                       resolve=lambda s, t: read_table(spark, f"{SF_SMALL}/{t}.parquet"),
                       target=lambda s, t: f"{root}/{s}/{t}", via_csv=True)
    assert out2["s1.nation"].count() == 25


def test_envelope_slice_half_open(spark):
    t0 = dt.datetime(2024, 1, 10)
    rows = [(i, t0 + dt.timedelta(hours=i), "t", '{"k": 1}', i) for i in range(48)]
    df = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, event_type string, "
                                     "props string, user_id long")
    a = int(dt.datetime(2024, 1, 10, 5, tzinfo=dt.timezone.utc).timestamp() * 1000)
    b = int(dt.datetime(2024, 1, 11, 5, tzinfo=dt.timezone.utc).timestamp() * 1000)
    env = table_as_envelope(df, "props", "event_type", "event_id", "ts", "user_id", 4, a, b)
    got = sorted(r["kafka_offset"] for r in slice_envelope(env, a, b).collect())
    assert got == list(range(5, 29))   # start inclusive, stop exclusive
    assert {r["kafka_partition"] for r in env.collect()} == {0, 1, 2, 3}


def test_refresh_twice_equals_once(spark):
    schema = "periode string, id long"
    base = spark.createDataFrame([("202401", 1), ("202402", 2), ("202402", 3)], schema)
    src = spark.createDataFrame([("202402", 7), ("202402", 8)], schema)
    t1, t2 = work_dir(spark, "t-r1"), work_dir(spark, "t-r2")
    write_periodic(base, t1, "periode")
    write_periodic(base, t2, "periode")
    once = period_refresh(spark, t1, src, "periode", "202402")
    period_refresh(spark, t2, src, "periode", "202402")
    twice = period_refresh(spark, t2, src, "periode", "202402")
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_refresh_strict_rejects_other_periods(spark):
    schema = "periode string, id long"
    t = work_dir(spark, "t-r3")
    write_periodic(spark.createDataFrame([("202401", 1)], schema), t, "periode")
    src = spark.createDataFrame([("202402", 7), ("202403", 8)], schema)
    try:
        period_refresh(spark, t, src, "periode", "202402", strict=True)
    except ValueError as e:
        assert "outside period" in str(e)
    else:
        raise AssertionError("strict refresh accepted rows of another period")


def test_slice_bounds():
    from tidemark.sources.kafka import slice_bounds
    a, b = slice_bounds(dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 10, 1))
    assert (a, b) == (1704844800000, 1704848400000)
    oslo = dt.timezone(dt.timedelta(hours=1))
    assert slice_bounds(dt.datetime(2024, 1, 10, 1, tzinfo=oslo), dt.datetime(2024, 1, 10, 2, tzinfo=oslo)) == (a, b)


def test_kafka_rows_to_envelope(spark):
    import hashlib
    from tidemark.sources.kafka import kafka_to_envelope
    ts = dt.datetime(2024, 3, 31, 1, 0, tzinfo=dt.timezone.utc)
    raw = spark.createDataFrame([(b'{"k": 1}', "topic-a", 7, ts, 2)],
                                "value binary, topic string, offset long, timestamp timestamp, "
                                "partition int")
    r = kafka_to_envelope(raw).first().asDict()
    assert r["kafka_message"] == '{"k": 1}' and r["kafka_topic"] == "topic-a"
    assert (r["kafka_offset"], r["kafka_partition"]) == (7, 2)
    assert r["kafka_timestamp"] == int(ts.timestamp() * 1000)
    assert r["kafka_hash"] == hashlib.sha256(b'{"k": 1}').hexdigest()
    assert dict(kafka_to_envelope(raw, "binary").dtypes)["kafka_message"] == "binary"


def test_stream_table_file_and_directory(spark):
    from tidemark.sources.tables import stream_table
    schema = read_table(spark, f"{SF_SMALL}/nation.parquet").schema
    d = work_dir(spark, "t-stream-dir")
    read_table(spark, f"{SF_SMALL}/nation.parquet").repartition(3).write.parquet(d)
    for path in (f"{SF_SMALL}/nation.parquet", d):
        name = "t_stream_" + str(abs(hash(path)))
        q = (stream_table(spark, path, schema).writeStream.format("memory").queryName(name)
             .trigger(availableNow=True).start())
        q.awaitTermination(120)
        assert spark.sql(f"SELECT COUNT(*) FROM {name}").first()[0] == 25


def test_refresh_period_with_escaped_characters(spark):
    schema = "periode string, id long"
    t = work_dir(spark, "t-r-esc")
    write_periodic(spark.createDataFrame([("2024/01:a", 1), ("2024-02", 2)], schema), t, "periode")
    out = period_refresh(spark, t, spark.createDataFrame([("2024/01:a", 9)], schema), "periode",
                         "2024/01:a")
    assert sorted(tuple(r) for r in out.collect()) == [("2024-02", 2), ("2024/01:a", 9)]


def test_csv_load_with_schema(spark):
    src = read_table(spark, f"{SF_SMALL}/customer.parquet").select("c_custkey", "c_acctbal")
    out = work_dir(spark, "t-csv-schema")
    export_csv(src, out)
    typed = load_csv(spark, out, schema="c_custkey long, c_acctbal double")
    assert dict(typed.dtypes) == {"c_custkey": "bigint", "c_acctbal": "double"}
    assert sorted(map(tuple, typed.collect())) == sorted(map(tuple, src.collect()))


def test_csv_keeps_every_value(spark):
    texts = ["plain", "line1\nline2", "  pad  ", "", None, 'say "hi"', "a,b", "back\\slash", "\\", '"', "\t", "é", '\\"', "x\r\ny"]
    src = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    out = work_dir(spark, "t-csv-lossless")
    export_csv(src.repartition(3), out)
    assert sorted(map(tuple, load_csv(spark, out, schema=src.schema).collect())) == list(enumerate(texts))
    inferred = load_csv(spark, out)
    assert dict(inferred.dtypes) == {"id": "int", "t": "string"}
    assert sorted(map(tuple, inferred.collect())) == list(enumerate(texts))


def test_replace_keeps_the_old_table_until_the_new_one_is_there(spark, monkeypatch):
    import tidemark.sources.versions as versions
    from tidemark.sources.tables import copy_table, read_table, replace_table
    target = work_dir(spark, "t-replace")
    read = lambda: read_table(spark, target, fmt="versioned")
    replace_table(spark.range(3), target)
    broken = spark.range(5).selectExpr("id", "raise_error('stop') as e")
    with pytest.raises(Exception):
        replace_table(broken, target)
    assert read().count() == 3
    began = read()
    # the target may be read by what replaces it
    assert copy_table(spark, read().where("id > 0"), target).count() == 2

    def stop(*args):
        raise OSError("stop")

    rename = versions.rename_path
    monkeypatch.setattr(versions, "rename_path", stop)
    with pytest.raises(OSError):
        replace_table(spark.range(9), target)
    monkeypatch.setattr(versions, "rename_path", rename)
    assert read().count() == 2 and began.count() == 3
    assert replace_table(spark.range(9), target).count() == 9 == read().count()


def test_a_reader_beside_a_writer_sees_whole_versions(spark):
    import threading
    from tidemark.sources.tables import read_table, replace_table
    target, sums, done = work_dir(spark, "t-beside"), [], threading.Event()
    replace_table(spark.range(100).selectExpr("id", "0 as v"), target)

    def reads():
        while not done.is_set() or len(sums) < 3:
            rows = read_table(spark, target, fmt="versioned").agg({"v": "sum", "id": "count"}).first()
            sums.append(tuple(rows))

    t = threading.Thread(target=reads)
    t.start()
    for v in range(1, 4):
        replace_table(spark.range(100).selectExpr("id", f"{v} as v").repartition(4), target)
    done.set()
    t.join()
    assert {x for s in sums for x in s if x == 100 or x % 100 == 0} >= {100}
    assert all(100 in s and sum(s) in (100, 200, 300, 400) for s in sums)


def test_jdbc_options():
    from tidemark.sources.tables import jdbc_options
    split = {"url": "jdbc:x", "partitionColumn": "id", "lowerBound": 0, "upperBound": 10, "numPartitions": 4}
    assert jdbc_options("t", split)["dbtable"] == "t"
    assert jdbc_options("SELECT a FROM t", split)["dbtable"] == "(SELECT a FROM t) q"
    assert jdbc_options("t", {"numPartitions": 1})["dbtable"] == "t"
    with pytest.raises(ValueError):
        jdbc_options("t", {"url": "jdbc:x"})


@pytest.mark.parametrize("stop", ["_new_cells", "publish", "after"])
def test_period_refresh_survives_a_stop(spark, monkeypatch, stop):
    import tidemark.operators.refresh as refresh
    schema = "periode string, v long"
    target = work_dir(spark, f"t-refresh-{stop}")
    old = [("202401", 1), ("202402", 2), ("202402", 3)]
    refresh.write_periodic(spark.createDataFrame(old, schema), target, "periode")
    source = spark.createDataFrame([("202402", 9), ("202403", 8)], schema)
    new = [("202401", 1), ("202402", 9), ("202403", 8)]
    name = "read_periodic" if stop == "after" else stop
    whole = getattr(refresh, name)

    def fail(*args, **kw):
        raise OSError("stop")

    monkeypatch.setattr(refresh, name, fail)
    with pytest.raises(OSError):
        refresh.period_refresh(spark, target, source, "periode", "202402", run="r1")
    monkeypatch.setattr(refresh, name, whole)
    read = lambda: sorted(map(tuple, refresh.read_periodic(spark, target).collect()))
    assert read() == (new if stop == "after" else old)
    refresh.period_refresh(spark, target, source, "periode", "202402", run="r1")
    assert read() == new
    # another refresh of the period has its own rows, whatever happened before
    newer = spark.createDataFrame([("202402", 77)], schema)
    refresh.period_refresh(spark, target, newer, "periode", "202402", run="r2")
    assert read() == [("202401", 1), ("202402", 77), ("202403", 8)]
    assert sorted(map(tuple, refresh.read_periodic(spark, target, periods=["202402", "209901"]).collect())) == [("202402", 77)]


def test_refresh_of_a_plain_folder_is_refused(spark):
    target = work_dir(spark, "t-plain")
    df = spark.createDataFrame([("202401", 1)], "periode string, v long")
    df.write.partitionBy("periode").parquet(target)
    with pytest.raises(ValueError):
        period_refresh(spark, target, df, "periode", "202401")


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

period_rows = st.lists(st.tuples(st.one_of(st.none(), st.sampled_from(["202401", "202402", "202403"])),
                                 st.integers(0, 99)), min_size=0, max_size=12)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=period_rows, source=period_rows, p=st.sampled_from(["202401", "202402", "202404"]))
def test_refresh_matches_delete_then_insert(spark, target, source, p):
    schema = "periode string, id long"
    t = work_dir(spark, "t-r-prop")
    write_periodic(spark.createDataFrame(target, schema), t, "periode")
    out = period_refresh(spark, t, spark.createDataFrame(source, schema), "periode", p)
    want = [r for r in target if r[0] != p] + list(source)   # NULL periods are kept
    key = lambda r: (r[0] or "", r[1])
    assert sorted(map(tuple, out.collect()), key=key) == sorted(want, key=key)

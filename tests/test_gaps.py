"""Offset gaps: hand-made edge cases and bucketed form == LEAD form."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators.gaps import gap_count, offset_gaps, offset_gaps_lead

SCHEMA = "topic string, part int, off long, loaded timestamp_ntz"


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_first_last_middle_gap_and_duplicates(spark):
    t0 = dt.datetime(2024, 1, 1)
    data = [("a", 0, o, t0) for o in [1, 2, 2, 5, 6, 9, 9, 20]] + \
           [("b", 0, o, t0) for o in [7]] + [("a", 0, None, t0)]
    df = spark.createDataFrame(data, SCHEMA)
    got = _rows(offset_gaps(df, "off", "topic", bucket_width=4))
    assert got == [("a", 2, 5, 2), ("a", 6, 9, 2), ("a", 9, 20, 10)]
    assert _rows(offset_gaps_lead(df.where("off is not null"), "off", "topic")) == got


def test_equal_offsets_in_two_partitions(spark):
    t0 = dt.datetime(2024, 1, 1)
    data = [("a", 0, 1, t0), ("a", 0, 3, t0), ("a", 1, 1, t0), ("a", 1, 2, t0), ("a", 1, 3, t0)]
    df = spark.createDataFrame(data, SCHEMA)
    by_topic = gap_count(df, "off", "topic").first()[0]
    by_part = gap_count(df, "off", ["topic", "part"]).first()[0]
    assert by_topic == 0      # partition 1 fills the hole of partition 0
    assert by_part == 1


def test_floor_and_min_gap(spark):
    t0 = dt.datetime(2024, 1, 1)
    data = [("a", 0, o, t0) for o in [1, 5, 10, 30, 31, 100]]
    df = spark.createDataFrame(data, SCHEMA)
    assert gap_count(df, "off", "topic", offset_floor=5, bucket_width=8).first()[0] == 2
    assert gap_count(df, "off", "topic", min_gap=10, bucket_width=8).first()[0] == 2
    assert gap_count(df, "off", "topic", min_gap=10, offset_floor=30,
                     bucket_width=8).first()[0] == 1


def test_filter_after_lead_uses_latest_copy(spark):
    d1, d2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    data = [("a", 0, 1, d1), ("a", 0, 1, d2), ("a", 0, 5, d1), ("a", 0, 6, d2), ("a", 0, 9, d2)]
    df = spark.createDataFrame(data, SCHEMA)
    after = F.col("loaded") > F.lit("2024-01-15").cast("timestamp_ntz")
    n = gap_count(df, "off", "topic", carry="loaded", after=after, bucket_width=2).first()[0]
    # gaps 1->5 (latest copy of 1 loaded in Feb) and 6->9 (loaded Feb); 5->6 is no gap
    assert n == 2
    for width in (2, 100):
        assert gap_count(df, "off", "topic", carry="loaded", after=after, bucket_width=width,
                         collapse_copies=False).first()[0] == 2


offsets = st.lists(st.integers(min_value=0, max_value=60), min_size=0, max_size=40)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(a=offsets, b=offsets, width=st.integers(min_value=1, max_value=17),
       min_gap=st.integers(min_value=1, max_value=5), floor=st.one_of(st.none(), st.integers(0, 30)))
def test_bucketed_equals_lead(spark, a, b, width, min_gap, floor):
    t0 = dt.datetime(2024, 1, 1)
    data = [("a", 0, o, t0) for o in a] + [("b", 0, o, t0) for o in b]
    df = spark.createDataFrame(data, SCHEMA)
    fast = offset_gaps(df, "off", "topic", min_gap=min_gap, offset_floor=floor, bucket_width=width)
    slow = offset_gaps_lead(df, "off", "topic", min_gap=min_gap, offset_floor=floor)
    one_shuffle = offset_gaps(df, "off", "topic", min_gap=min_gap, offset_floor=floor,
                              bucket_width=width, collapse_copies=False)
    assert _rows(fast) == _rows(slow) == _rows(one_shuffle)


def test_type_filter_inside_shows_other_types_as_gaps(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [("t", 0, o, t0, "A" if o % 3 else "B") for o in range(1, 13)]
    df = spark.createDataFrame(rows, SCHEMA + ", typ string")
    inside = gap_count(df.where(F.col("typ") == "A"), "off", "topic").first()[0]
    # offsets 3, 6, 9 are type B: filtered out before LEAD they become three gaps
    assert inside == 3
    assert gap_count(df, "off", "topic").first()[0] == 0


def test_links_across_buckets_of_buckets(spark):
    from tidemark.operators import gaps
    far = [0, 1, 5, 2**30, 2**30 + 1, 2**45, 2**45 + 3, 2**62]
    df = spark.createDataFrame([("a", 0, o, None) for o in far] + [("b", 0, 9, None)], SCHEMA)
    for width in (1, 2, 1 << 20):
        got = gaps.offset_gaps(df, "off", "topic", bucket_width=width)
        assert _rows(got) == _rows(gaps.offset_gaps_lead(df, "off", "topic"))


pairs = st.lists(st.tuples(st.integers(0, 40), st.integers(1, 28)), min_size=0, max_size=40)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(a=pairs, width=st.integers(min_value=1, max_value=13), collapse=st.booleans())
def test_carry_with_copies_equals_lead(spark, a, width, collapse):
    data = [("a", 0, o, dt.datetime(2024, 1, d)) for o, d in a]
    df = spark.createDataFrame(data, SCHEMA)
    fast = offset_gaps(df, "off", "topic", carry="loaded", bucket_width=width,
                       collapse_copies=collapse)
    slow = offset_gaps_lead(df, "off", "topic", carry="loaded")
    assert _rows(fast.select("topic", "gap_from", "gap_to", "loaded", "missing")) == \
        _rows(slow.select("topic", "gap_from", "gap_to", "loaded", "missing"))

"""Registered queries over the driver tables (one per operator key).

Role map (the driver tables stand in for the warehouse tables):

* ``events`` is the landing table: ``event_type`` = topic, ``event_id`` =
  offset, ``user_id`` mod 4 = partition, ``ts`` = load / received time (UTC),
  ``props`` = JSON message, its key ``k`` = payload key;
* ``customer`` gives the identity dimension and the unpacked-case table;
* ``part`` / ``lineitem`` give code domains and mappings;
* ``lineitem`` is the wide allowance table and the fact table of the monthly
  reconciliation; ``orders`` the run history and the refreshed table.

``AS_OF`` stands for ``sysdate``.  Every query reads whole tables; nothing is
sampled or capped.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.json import json_key, json_value
from tidemark.functions.periods import (blank_default, coupled_default, daily_window, month_text,
                                        period_range, period_type, period_window,
                                        prev_month_end, prev_period, week_cycle)
from tidemark.functions.timez import (date_text, local_day, minute, ntz_to_unix_ms, parse_ts_ms, ts_literal,
                                      unix_ms_to_local, unix_ms_to_ntz)
from tidemark.operators.counts import (calendar_bound, count_metrics, recent_counts,
                                       recent_distinct, rolling_bound, typed_counts)
from tidemark.operators.gaps import gap_count, offset_gaps
from tidemark.operators.ingest import apply_spec, ingest_batch, ingest_many, skip_duplicates
from tidemark.operators.joins import (new_values, not_in_values, unmatched_count,
                                      validity_join_count)
from tidemark.operators.reconcile import distinct_by_code, reconcile_subset
from tidemark.operators.refresh import period_refresh, write_periodic
from tidemark.operators.runs import run_success_counts, run_success_report
from tidemark.plans import landing_queries
from tidemark.plans.checks import GapCheck, Tagged, domain_counts, gap_counts, person_counts, tagged_rows
from tidemark.plans.inputs import (AS_OF, BATCH_TIME, OFFSET_FLOOR, REPLAY_A, REPLAY_B, REPLAY_TIME, SLICE, Query,
                                   events_envelope, landing_spec, spec_without, table)
from tidemark.plans.reports import (code_lists, gap_alert, joined_lines, metric_rows, monthly_reconciliation,
                                    report_lines, report_text)
from tidemark.session import work_dir
from tidemark.sources.kafka import slice_envelope
from tidemark.sources.tables import copy_table, read_table

# --------------------------------------------------------------------------- gaps

def q_gap_count(spark, sf):
    """Gaps per topic, offsets above the floor (floor pushed below LEAD)."""
    ev = table(spark, sf, "events")
    return gap_count(ev, "event_id", "event_type", min_gap=1, offset_floor=OFFSET_FLOOR)


def q_gap_count_typed(spark, sf):
    """Type filter applied before LEAD."""
    ev = table(spark, sf, "events").where(F.col("event_type") == "click")
    return gap_count(ev, "event_id", "event_type", min_gap=1, offset_floor=OFFSET_FLOOR)


def q_gap_count_since(spark, sf):
    """Load-date bound applied after LEAD (carried column)."""
    ev = table(spark, sf, "events")
    return gap_count(ev, "event_id", "event_type", carry="ts",
                     after=F.col("ts") > date_text("15.01.2024"))


def q_gap_count_partitioned(spark, sf):
    """Per (supplier, line number) over order keys, date filter inside, gap > 900."""
    li = table(spark, sf, "lineitem").where(F.col("l_shipdate") > date_text("16.04.1996"))
    return gap_count(li, "l_orderkey", ["l_suppkey", "l_linenumber"], min_gap=900)


def q_gap_list(spark, sf):
    """Every gap as (topic, from, to, missing)."""
    return offset_gaps(table(spark, sf, "events"), "event_id", "event_type")


# ------------------------------------------------------------------------- counts

def q_recent_count(spark, sf):
    """F1/A1: counts in rolling windows (>= 1 and 7 days, > 8 days) in one pass."""
    return recent_counts(table(spark, sf, "events"), "ts", AS_OF,
                         {"n_1d": (1, True), "n_7d": (7, True), "n_8d_excl": (8, False)})


def q_recent_days(spark, sf):
    """calendar-day window written as a range on the timestamp."""
    ev = table(spark, sf, "events")
    return count_metrics(ev, {"n_recent_days": None}, where=calendar_bound("ts", AS_OF, 7))


def q_typed_counts(spark, sf):
    """Total plus three types in one pass."""
    return typed_counts(table(spark, sf, "events"), "ts", AS_OF, 7, "event_type",
                        {"n_click": "click", "n_view": "view", "n_purchase": "purchase"})


def q_distinct_count(spark, sf):
    """A2: exact distinct users in the last day."""
    return recent_distinct(table(spark, sf, "events"), "ts", AS_OF, 1, "user_id",
                           name="n_distinct_users")


# ----------------------------------------------------------------- scalar / time

def q_json_value(spark, sf):
    """JSON_VALUE of a present and a missing key."""
    ev = table(spark, sf, "events")
    return ev.select("event_id", json_value("props", "$.k").alias("k"),
                     json_value("props", "$.missing").alias("missing"))


def json_shapes(spark, sf) -> DataFrame:
    """Documents of ten shapes, made from the events' ids."""
    n, k = F.col("event_id").cast("string"), F.col("event_id") % 10
    parts = ['{"k":{"a":#}}', '{"k":[#]}', '{"k":null}', '{"k":"#"}', '{"k":#', '{"k":{"a":1,"a":#}}',
             '{"a.b":"#","a":{"b":"y"},"k":"{#}"}', '{"z":1,"z":2,"k":#}',
             '{"k":{"a":#},"x":"{\\"a\\":#}","z":1,"z":2}', '{"k":"[#]","z":1,"z":2}']
    doc = F.element_at(F.array(*[F.lit(p) for p in parts]), k.cast("int") + 1)
    return table(spark, sf, "events").select("event_id", F.replace(doc, F.lit("#"), n).alias("doc"))


def q_json_shapes(spark, sf):
    """Containers, JSON null, broken text, repeated and dotted keys."""
    return json_shapes(spark, sf).select("event_id", json_value("doc", "$['k']").alias("k"),
                                         json_key("doc", "a.b").alias("dotted"), json_key("doc", "a/b").alias("nested"))


def q_text_decision_day(spark, sf):
    """Timestamp text in a payload to a timestamp, its zone, its day; bad text gives none."""
    stamp = F.when(F.col("event_id") % 5 == 0, F.lit("2024-13-45")).otherwise(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"))
    ev = table(spark, sf, "events").select("event_id", F.to_json(F.struct(stamp.alias("decided"))).alias("doc"))
    return ev.select("event_id", local_day(parse_ts_ms(json_value("doc", "$['decided']"))).cast("string").alias("decision_day"))


def q_changed_minutes(spark, sf):
    """rows changed in a later minute than created, on one table with two timestamps."""
    ev = table(spark, sf, "events").select(F.col("ts").alias("created"), F.timestamp_add(
        "SECOND", (F.col("event_id") % 50).cast("int"), F.col("ts")).alias("changed"))
    return ev.agg(F.count_if(minute("created") != minute("changed")).alias("n_changed"),
                  F.count_if(F.col("created") != F.col("changed")).alias("n_touched"))


def q_gap_count_copies(spark, sf):
    """Gaps where some offsets are there several times and others are missing."""
    ev = table(spark, sf, "events").select("event_id", "event_type").where("event_id % 11 <> 3")
    return gap_count(ev.unionByName(ev.where("event_id % 5 = 0")).unionByName(ev.where("event_id % 7 = 0")),
                     "event_id", "event_type", min_gap=1)


def q_local_decision_day(spark, sf):
    """UTC wall clock to Europe/Belgrade day."""
    ev = table(spark, sf, "events")
    return ev.select("event_id", local_day("ts", "UTC", "Europe/Belgrade").alias("decision_day"))


def q_unix_ms_local(spark, sf):
    """P5: epoch milliseconds and their Europe/Oslo wall clock."""
    ev = table(spark, sf, "events")
    ms = ntz_to_unix_ms("ts")
    return ev.select("event_id", ms.alias("kafka_timestamp"),
                     unix_ms_to_local(ms, "Europe/Oslo").alias("kafka_mottatt_dato"))


def q_message_hash(spark, sf):
    """SHA-256 of the message text."""
    ev = table(spark, sf, "events")
    return ev.select("event_id", F.sha2(F.col("props"), 256).alias("kafka_hash"))


# ------------------------------------------------------------------------- joins

def identity_spans(lo: str, hi: str) -> Column:
    """Two rule-based validity intervals of a customer, some overlapping."""
    base, k = F.lit("2024-01-01").cast("date"), F.col("c_custkey")

    def interval(a, b):
        return F.struct(F.date_add(base, a.cast("int")).alias(lo), F.date_add(base, b.cast("int")).alias(hi))

    return F.array(interval(k % 20, k % 20 + k % 7), interval(k % 5 + 20, k % 5 + 30))


def identity_dim(spark, sf) -> DataFrame:
    """Validity intervals per customer, produced in one scan of ``customer``."""
    c = table(spark, sf, "customer")
    return c.select(F.col("c_custkey").cast("string").alias("off_id"), F.col("c_nationkey").alias("skjermet_kode"),
                    F.inline(identity_spans("gyldig_fra_dato", "gyldig_til_dato")))


def _validity_count(spark, sf, key_col) -> DataFrame:
    ev = table(spark, sf, "events").where(rolling_bound("ts", AS_OF, 7))
    facts = ev.select(key_col.alias("person"),
                      local_day("ts", "UTC", "Europe/Belgrade").alias("decision_day"))
    dim = identity_dim(spark, sf).where(F.col("skjermet_kode").isin(6, 7))
    return validity_join_count(facts, dim, "person", "off_id", "decision_day", "gyldig_fra_dato",
                               "gyldig_til_dato", name="n_rows")


def q_validity_join_count(spark, sf):
    """Join rows of messages with protected validity intervals."""
    return _validity_count(spark, sf, json_value("props", "$.k"))


UNPACKED_EXCEPT = "HOUSEHOLD"   # cases of this segment are "not unpacked"


def q_unmatched_messages(spark, sf):
    """Recent messages whose case is not unpacked."""
    ev = table(spark, sf, "events").where(calendar_bound("ts", AS_OF, 7))
    cases = (table(spark, sf, "customer").where(F.col("c_mktsegment") != UNPACKED_EXCEPT)
             .select(F.col("c_custkey").cast("string").alias("case_id")))
    msgs = ev.select(json_value("props", "$.k").alias("case_ref"))
    return unmatched_count(msgs, cases, "case_ref", "case_id", name="n_unmatched")


def _sold_big(spark, sf) -> DataFrame:
    return table(spark, sf, "lineitem").where(F.col("l_quantity") > 49)


def q_new_codes(spark, sf):
    """Part keys not among parts sold in quantities above 49 (NULL counts as new)."""
    return new_values(table(spark, sf, "part"), "p_partkey", _sold_big(spark, sf), "l_partkey",
                      name="code")


def q_new_codes_not_in(spark, sf):
    """The same with NOT IN semantics."""
    return not_in_values(table(spark, sf, "part"), "p_partkey", _sold_big(spark, sf), "l_partkey",
                         name="code")


def q_new_codes_not_in_null(spark, sf):
    """NOT IN against a domain holding NULL (no rows)."""
    li = table(spark, sf, "lineitem").select(
        F.when(F.col("l_quantity") > 49, F.col("l_partkey")).alias("l_partkey"))
    return not_in_values(table(spark, sf, "part"), "p_partkey", li, "l_partkey", name="code")


PATCHED_SINCE = _dt.datetime(1998, 1, 1)


def q_patched_rows(spark, sf):
    """Rows whose change minute differs from the creation minute.

    ``lineitem`` is collapsed to (order, ship minute, n) before the join, so a
    hot order key costs one row per minute and map task.
    """
    li = (table(spark, sf, "lineitem").where(F.col("l_shipdate") >= ts_literal(PATCHED_SINCE))
          .groupBy("l_orderkey", minute("l_shipdate").alias("changed_minute"))
          .agg(F.count(F.lit(1)).alias("_n")))
    o = table(spark, sf, "orders").select("o_orderkey", minute("o_orderdate").alias("created_minute"))
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"])
    return (j.where(F.col("created_minute") != F.col("changed_minute"))
            .agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("n_patched")))


# ------------------------------------------------------------ unpivot / reconcile

# Fixed labels of the unpivoted amount columns (ours).
AMOUNT_COLUMNS = {"TAX": "tax", "DISCOUNT": "discount", "QUANTITY": "quantity"}


def wide_amounts(spark, sf) -> DataFrame:
    li = table(spark, sf, "lineitem")
    return li.select(month_text("l_shipdate").alias("periode"),
                     F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status"),
                     "l_suppkey",
                     F.nullif(F.col("l_tax"), F.lit(0.0)).alias("tax"),
                     F.nullif(F.col("l_discount"), F.lit(0.0)).alias("discount"),
                     F.nullif(F.col("l_quantity"), F.lit(0.0)).alias("quantity"))


def q_unpivot_distinct(spark, sf):
    """Distinct suppliers per month, flag, status and amount code."""
    return distinct_by_code(wide_amounts(spark, sf), ["periode", "flag", "status"], AMOUNT_COLUMNS,
                            "l_suppkey", label="code", name="n_suppliers")


SEGMENTS = ("AUTOMOBILE", "BUILDING", "MACHINERY")


def q_star_distinct(spark, sf):
    """Distinct customers per month, segment and status over a star join."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_shipdate")
    o = table(spark, sf, "orders").where(F.col("o_orderstatus").isin("F", "O")) \
        .select("o_orderkey", "o_custkey", "o_orderstatus")
    c = table(spark, sf, "customer").where(F.col("c_mktsegment").isin(*SEGMENTS)) \
        .select("c_custkey", "c_mktsegment", "c_nationkey")
    n = table(spark, sf, "nation").select("n_nationkey")
    fact = (li.join(o, li["l_orderkey"] == o["o_orderkey"])
            .join(c, F.col("o_custkey") == F.col("c_custkey"))
            .join(n, F.col("c_nationkey") == F.col("n_nationkey")))
    return (fact.groupBy(month_text("l_shipdate").alias("periode"),
                         F.col("c_mktsegment").alias("segment"),
                         F.col("o_orderstatus").alias("status"))
            .agg(F.count_distinct("o_custkey").alias("n_customers")))


def _recon(spark, sf) -> DataFrame:
    rows = table(spark, sf, "lineitem").select(
        month_text("l_shipdate").alias("periode"), F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status"),
        "l_suppkey", (F.col("l_discount") > 0.05).alias("discounted"))
    return reconcile_subset(rows, ["periode", "flag"], ["status"], "l_suppkey", "discounted", name="n_suppliers")


def q_reconcile_diff(spark, sf):
    """Rows whose count exceeds the compared count."""
    return _recon(spark, sf)


RECON_PERIOD = "199806"


def q_reconcile_first(spark, sf):
    """O2: the first reconciliation row of one period (top 1 by difference)."""
    return (_recon(spark, sf).where(F.col("periode") == RECON_PERIOD)
            .orderBy(F.col("diff").desc(), "periode", "flag", "status").limit(1))


# The facts count the same suppliers through the star; a discount
# of exactly this size has no cell in the wide table, so its keys are missing there.
CODE_RATES = {"TAX": ("l_tax", 0.08), "DISCOUNT": ("l_discount", 0.10)}


def q_monthly_reconciliation(spark, sf):
    """Suppliers per month, flag and code in the fact star (with the segment as
    an extra key) against the unpivoted wide table; keys without wide cells are reported."""
    wide = wide_amounts(spark, sf).where(F.col("status") == "O").select(
        "periode", "flag", "l_suppkey", F.when(F.col("tax") < CODE_RATES["TAX"][1], F.col("tax")).alias("tax"),
        F.when((F.col("discount") < CODE_RATES["DISCOUNT"][1]) & (F.col("flag") == "N"), F.col("discount")).alias("discount"))
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_shipdate", "l_returnflag", "l_tax", "l_discount")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    star = (li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey"))
            .select(month_text("l_shipdate").alias("periode"), F.col("l_returnflag").alias("flag"),
                    F.col("c_mktsegment").alias("segment"), "l_suppkey",
                    *[F.nullif(F.col(col), F.lit(0.0)).alias(code.lower()) for code, (col, _) in CODE_RATES.items()]))
    codes = {code: code.lower() for code in CODE_RATES}
    facts = distinct_by_code(star, ["periode", "flag", "segment"], codes, "l_suppkey")
    out = monthly_reconciliation(wide, ["periode", "flag"], codes, "l_suppkey", facts, ["periode", "flag", "code"],
                                 report_missing=True)
    missing = F.col("n_distinct_wide").isNull()
    return out.select("periode", "flag", "segment", "code", "n_distinct",
                      F.coalesce("n_distinct_wide", F.lit(0)).alias("n_distinct_wide"), missing.alias("missing"))


# ---------------------------------------------------------------- sources / sinks

def q_interval_slice(spark, sf):
    """One closed time slice of the landing table as an envelope."""
    return slice_envelope(events_envelope(spark, sf, *SLICE), *SLICE)


def q_table_scan(spark, sf):
    """A column list read."""
    return read_table(spark, f"{sf.rstrip('/')}/nation.parquet", ["n_nationkey", "n_name"])


def q_table_scan_all(spark, sf):
    """A ``*`` read."""
    return read_table(spark, f"{sf.rstrip('/')}/nation.parquet")


COPY_COLUMNS = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]


def q_table_copy(spark, sf):
    """Full-refresh copy with a column list."""
    return copy_table(spark, table(spark, sf, "customer"), work_dir(spark, "copy-customer"),
                      COPY_COLUMNS)


#: Names that are hard for CSV, by the customer's key: NULL, empty, quotes, line ends, blanks, backslashes, separators.
HARD_NAMES = ("CAST(NULL AS STRING)", "''", "concat('\"', c_name, '\", he said')", "concat(c_name, '\\n', 'second; line')",
              "concat('  ', c_name, ' ')", "concat('C:\\\\', c_name, '\\\\')", "concat(',,', c_name, '\\r\\n')", "'Å\\t\"\"'", "c_name")


def q_csv_roundtrip(spark, sf):
    """CSV stage and load with inferred types, replacing the target; every ninth name is NULL,
    others are empty or hold quotes, separators, line ends and blanks."""
    name = F.element_at(F.array(*[F.expr(e) for e in HARD_NAMES]), (F.col("c_custkey") % len(HARD_NAMES)).cast("int") + 1)
    return copy_table(spark, table(spark, sf, "customer").withColumn("c_name", name), work_dir(spark, "csv-customer"),
                      via_csv=True)


# ------------------------------------------------------------------------ ingest

def q_ingest_map(spark, sf):
    """The config-driven field maps of one batch."""
    return apply_spec(events_envelope(spark, sf), landing_spec(), BATCH_TIME)


LANDED_UNTIL = _dt.datetime(2024, 1, 20)
INCOMING_FROM = _dt.datetime(2024, 1, 15)
REPEATED_FROM = _dt.datetime(2024, 1, 28)


def q_skip_duplicates(spark, sf):
    """Target = messages landed before Jan 20; incoming = everything from Jan 15
    on, with the last days delivered twice; some messages have no offset and are
    all new.  Result: the rows to append."""
    env = events_envelope(spark, sf)
    offset = F.when(F.col("kafka_offset") % 97 != 0, F.col("kafka_offset"))
    cols = [F.col("kafka_topic"), F.col("kafka_partition"), offset.alias("kafka_offset"),
            F.col("kafka_message").alias("melding")]
    ts = unix_ms_to_ntz(F.col("kafka_timestamp"))
    target = env.where(ts < ts_literal(LANDED_UNTIL)).select(*cols)
    incoming = (env.where(ts >= ts_literal(INCOMING_FROM)).select(*cols)
                .unionByName(env.where(ts >= ts_literal(REPEATED_FROM)).select(*cols)))
    return skip_duplicates(incoming, target, ["kafka_topic", "kafka_partition", "kafka_offset"])


FAN_IN = {"click": "CLICK", "view": "VIEW", "purchase": "PURCHASE"}


def q_fan_in_ingest(spark, sf):
    """Three topics, three type literals, one shared target (one dedupe, one append)."""
    target = work_dir(spark, "fan-in")
    parts = []
    for topic, literal in FAN_IN.items():
        spec = spec_without(landing_spec(topic, literal), "ytelse_type", "kafka_mottatt_dato")
        parts.append((spec, events_envelope(spark, sf).where(F.col("kafka_topic") == topic)))
    ingest_many(spark, parts, target, BATCH_TIME)
    return spark.read.parquet(target).select(*parts[0][0].columns)


def q_replay_idempotent(spark, sf):
    """ST2: two overlapping slices land each message once."""
    target = work_dir(spark, "replay")
    spec = spec_without(landing_spec(), "ytelse_type", "type_stonad")
    ingest_batch(spark, spec, events_envelope(spark, sf, *REPLAY_A), target, BATCH_TIME)
    ingest_batch(spark, spec, events_envelope(spark, sf, *REPLAY_B), target, REPLAY_TIME)
    return spark.read.parquet(target).select(*spec.columns)


# ------------------------------------------------------------------- run history

RUN_WINDOW = (_dt.datetime(1996, 1, 1, 10), _dt.datetime(1997, 1, 1, 10))


def _runs(spark, sf) -> DataFrame:
    return run_success_counts(table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus",
                              "o_orderdate", *RUN_WINDOW, state="F")


def q_run_success_counts(spark, sf):
    """Successful runs per job in a half-open window."""
    return _runs(spark, sf)


def q_run_success_report(spark, sf):
    """The run counts as report text."""
    return run_success_report(_runs(spark, sf))


# ----------------------------------------------------------------------- periods

def ship_days(spark, sf) -> DataFrame:
    return table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("d")).distinct()


def q_prev_period(spark, sf):
    """Previous month."""
    return ship_days(spark, sf).select("d", prev_period("d").alias("prev_period"))


def q_prev_month_end(spark, sf):
    """Last day of the previous month."""
    return ship_days(spark, sf).select("d", prev_month_end("d").alias("prev_month_end"))


def q_period_type(spark, sf):
    """Run type of a date."""
    return ship_days(spark, sf).select("d", period_type("d").alias("period_type"))


def q_period_window(spark, sf):
    """T4: period window and label by run type."""
    cols = period_window("d", shift_days=1)
    return ship_days(spark, sf).select("d", *[c.alias(n) for n, c in cols.items()])


def q_daily_window(spark, sf):
    """T5: daily rolling period window."""
    cols = daily_window("d")
    return ship_days(spark, sf).select("d", *[c.alias(n) for n, c in cols.items()])


# Our own duty roster for the weekly rotation.
ROSTER = ("Ada", "Bjorn", "Cato", "Dina")


def q_week_cycle(spark, sf):
    """Person on duty by ISO week."""
    return ship_days(spark, sf).select("d", F.weekofyear("d").alias("week"),
                                       week_cycle("d", ROSTER).alias("on_duty"))


def q_blank_default(spark, sf):
    """Settings with defaults and the coupled period/flag default."""
    c = table(spark, sf, "customer")
    seg = F.col("c_mktsegment")
    setting = (F.when(seg == "BUILDING", F.lit(""))
               .when(seg == "AUTOMOBILE", F.lit(None).cast("string"))
               .otherwise(F.col("c_nationkey").cast("string")))
    period_setting = F.when(seg.isin("BUILDING", "MACHINERY"), F.lit("")).otherwise(
        F.concat(F.lit("1998"), F.lpad(((F.col("c_nationkey") % 12) + 1).cast("string"), 2, "0")))
    flag_setting = F.col("c_nationkey") % 2
    staged = c.select("c_custkey", setting.alias("setting"), period_setting.alias("period_setting"),
                      flag_setting.alias("flag_setting"))
    periode, flag = coupled_default("period_setting", "flag_setting",
                                    prev_period(ts_literal(AS_OF)))
    return staged.select("c_custkey", "setting",
                         blank_default("setting", 1, "int").alias("value"),
                         periode.alias("periode"), flag.alias("gyldig_flagg"))


PERIOD_FILTER = ("199801", "199806", "19980615")


def q_period_filter(spark, sf):
    """F8: month range and latest decision date as a pushed-down range."""
    li = table(spark, sf, "lineitem")
    return (li.where(period_range("l_shipdate", *PERIOD_FILTER))
            .select("l_orderkey", "l_linenumber", "l_shipdate", F.lit(1).alias("gyldig_flagg")))


REFRESH_PERIOD = "199806"
REFRESH_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                   "periode"]


def q_period_refresh(spark, sf):
    """M1: replace one period of the table with the source's rows.  The source holds other
    periods too, which are added; rows without a period stay.  The refresh runs twice
    under one name and is applied once."""
    o = table(spark, sf, "orders").withColumn("periode", F.when(F.col("o_orderkey") % 13 != 0, month_text("o_orderdate")))
    target = work_dir(spark, "refresh-target")
    write_periodic(o.select(*REFRESH_COLUMNS), target, "periode")
    source = (o.where((F.col("periode") == REFRESH_PERIOD) & (F.col("o_orderkey") % 3 != 0)
                      | (F.col("o_orderkey") % 101 == 0))
              .withColumn("o_orderstatus", F.lit("X")).select(*REFRESH_COLUMNS))
    for _ in range(2):
        out = period_refresh(spark, target, source, "periode", REFRESH_PERIOD, REFRESH_COLUMNS, run="june")
    return out


# ----------------------------------------------------------------------- reports

DAILY_ORDER = ["events_1d", "click_1d", "view_1d", "purchase_1d", "signup_1d", "error_1d",
               "users_1d", "events_7d"]
# Fixed report labels (ours).
DAILY_LABELS = {
    "events_1d": "Messages received, last day",
    "click_1d": "Click messages",
    "view_1d": "View messages",
    "purchase_1d": "Purchase messages",
    "signup_1d": "Signup messages",
    "error_1d": "Error messages",
    "users_1d": "Distinct users",
    "events_7d": "Messages received over the last seven days, all types and topics together",
}


def daily_counts(spark, sf) -> DataFrame:
    ev = table(spark, sf, "events").where(rolling_bound("ts", AS_OF, 7))
    day = rolling_bound("ts", AS_OF, 1)
    typ = F.col("event_type")
    return ev.agg(
        F.count_if(day).alias("events_1d"),
        F.count_if(day & (typ == "click")).alias("click_1d"),
        F.count_if(day & (typ == "view")).alias("view_1d"),
        F.count_if(day & (typ == "purchase")).alias("purchase_1d"),
        F.count_if(day & (typ == "signup")).alias("signup_1d"),
        F.count_if(day & (typ == "error")).alias("error_1d"),
        F.count_distinct(F.when(day, F.col("user_id"))).alias("users_1d"),
        F.count(F.lit(1)).alias("events_7d"),
    )


def q_daily_report(spark, sf):
    """The daily metrics as (pos, metric, value) rows."""
    return metric_rows(daily_counts(spark, sf), DAILY_ORDER)


def q_report_lines(spark, sf):
    """Dot-leader report lines."""
    return report_lines(q_daily_report(spark, sf), DAILY_LABELS)


def since(days: int) -> str:
    """The report's first moment as text, from ``AS_OF``."""
    return f"{AS_OF - _dt.timedelta(days=days):%Y-%m-%d %H:%M:%S}"


#: Several counts on one line, as ``a/b/c``.
JOINED_LINES = {"types_1d": ("Messages by type (click/view/purchase)", ("click_1d", "view_1d", "purchase_1d"))}


def q_daily_report_text(spark, sf):
    """The daily report text with the week's name on duty and a line of several counts."""
    counts = daily_counts(spark, sf)
    week = (AS_OF.isocalendar().week - 1) % len(ROSTER)
    header = f"Daily report, messages read since {since(1)}\nOn duty this week: {ROSTER[week]}"
    single = report_lines(metric_rows(counts, DAILY_ORDER), DAILY_LABELS)
    joined = joined_lines(counts, JOINED_LINES, len(DAILY_ORDER))
    return report_text(single.unionByName(joined), header)


def q_gap_alert(spark, sf):
    """Names of the checks that found gaps, or the all-clear text; one scan per table."""
    events = gap_counts(table(spark, sf, "events"), "event_id", ["event_type"], {
        "events": GapCheck(offset_floor=OFFSET_FLOOR),
        "events click": GapCheck(F.col("event_type") == "click", OFFSET_FLOOR),
        "events since 15.01": GapCheck(after=F.col("ts") > date_text("15.01.2024")),
    }, carry="ts")
    items = gap_counts(table(spark, sf, "lineitem"), "l_orderkey", ["l_suppkey", "l_linenumber"], {
        "lineitem by supplier": GapCheck(F.col("l_shipdate") > date_text("16.04.1996"), min_gap=900)})
    return gap_alert(metric_rows(events).unionByName(metric_rows(items, after=3)))


def q_weekly_report(spark, sf):
    """The weekly metrics; each table is read once."""
    key, day = F.col("k"), F.col("decision_day")
    ev = table(spark, sf, "events").select("ts", json_value("props", "$.k").alias("k"), F.col("user_id").cast("string").alias("user"),
                                           local_day("ts", "UTC", "Europe/Belgrade").alias("decision_day"))
    recent = rolling_bound("ts", AS_OF, 7)
    facts = tagged_rows(ev, {
        "validity_by_payload_key": Tagged(key, day, recent),
        "validity_by_user": Tagged(F.col("user"), day, recent),
        "unmatched_messages": Tagged(key, None, calendar_bound("ts", AS_OF, 7)),
    }, "date", "string")
    # protected persons' intervals, and a row without bounds for each unpacked case
    persons = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("person"), F.inline(F.concat(
        F.when(F.col("c_nationkey").isin(6, 7), identity_spans("lo", "hi")).otherwise(F.array()),
        F.when(F.col("c_mktsegment") != UNPACKED_EXCEPT, F.array(F.struct(
            F.lit(None).cast("date").alias("lo"), F.lit(None).cast("date").alias("hi")))).otherwise(F.array()))))
    people = person_counts(facts, persons, ["validity_by_payload_key", "validity_by_user"], ["unmatched_messages"])
    left = tagged_rows(table(spark, sf, "lineitem"), {
        "part": Tagged(F.col("l_partkey"), None, F.col("l_quantity") > 49),
        "supplier": Tagged(F.col("l_suppkey")),
        "order": Tagged(F.col("l_orderkey"), minute("l_shipdate"), F.col("l_shipdate") >= ts_literal(PATCHED_SINCE)),
    }, "timestamp_ntz")
    right = [tagged_rows(table(spark, sf, name), {tag: part}, "timestamp_ntz") for name, tag, part in (
        ("part", "part", Tagged(F.col("p_partkey"))),
        ("supplier", "supplier", Tagged(F.col("s_suppkey"), None, F.col("s_acctbal") > 0)),
        ("orders", "order", Tagged(F.col("o_orderkey"), minute("o_orderdate"))))]
    codes = domain_counts(left, right[0].unionByName(right[1]).unionByName(right[2]), {"new_part_codes": "part"},
                          {"new_supplier_codes": "supplier"}, {"new_part_codes_not_in": "part"}, {"patched_rows": "order"})
    return metric_rows(people).unionByName(metric_rows(codes, after=3))


# Fixed report labels of the weekly report (ours).
WEEKLY_LABELS = {
    "validity_by_payload_key": "Protected persons by payload key, not unpacked",
    "validity_by_user": "Protected persons by user, not unpacked",
    "unmatched_messages": "Messages not unpacked",
    "new_part_codes": "New part codes",
    "new_supplier_codes": "New supplier codes",
    "new_part_codes_not_in": "New part codes (NOT IN)",
    "patched_rows": "Rows changed after creation",
}


def q_weekly_report_text(spark, sf):
    """The weekly report text."""
    return report_text(report_lines(q_weekly_report(spark, sf), WEEKLY_LABELS),
                       f"Weekly report, messages read since {since(7)}")


def q_weekly_new_codes(spark, sf):
    """The new codes themselves, one row per code under its list's name."""
    li = table(spark, sf, "lineitem")
    sup = table(spark, sf, "supplier").where(F.col("s_acctbal") > 0)
    return code_lists({"new_part_codes": q_new_codes(spark, sf),
                       "new_supplier_codes": new_values(li, "l_suppkey", sup, "s_suppkey"),
                       "new_part_codes_not_in": q_new_codes_not_in(spark, sf)})


QUERIES: dict[str, Query] = {
    "gap_count": q_gap_count,
    "gap_count_typed": q_gap_count_typed,
    "gap_count_since": q_gap_count_since,
    "gap_count_partitioned": q_gap_count_partitioned,
    "gap_list": q_gap_list,
    "recent_count": q_recent_count,
    "recent_days": q_recent_days,
    "typed_counts": q_typed_counts,
    "distinct_count": q_distinct_count,
    "json_value": q_json_value,
    "json_shapes": q_json_shapes,
    "text_decision_day": q_text_decision_day,
    "changed_minutes": q_changed_minutes,
    "gap_count_copies": q_gap_count_copies,
    "local_decision_day": q_local_decision_day,
    "unix_ms_local": q_unix_ms_local,
    "message_hash": q_message_hash,
    "validity_join_count": q_validity_join_count,
    "unmatched_messages": q_unmatched_messages,
    "new_codes": q_new_codes,
    "new_codes_not_in": q_new_codes_not_in,
    "new_codes_not_in_null": q_new_codes_not_in_null,
    "patched_rows": q_patched_rows,
    "unpivot_distinct": q_unpivot_distinct,
    "star_distinct": q_star_distinct,
    "reconcile_diff": q_reconcile_diff,
    "reconcile_first": q_reconcile_first,
    "monthly_reconciliation": q_monthly_reconciliation,
    "interval_slice": q_interval_slice,
    "table_scan": q_table_scan,
    "table_scan_all": q_table_scan_all,
    "table_copy": q_table_copy,
    "csv_roundtrip": q_csv_roundtrip,
    "ingest_map": q_ingest_map,
    "skip_duplicates": q_skip_duplicates,
    "fan_in_ingest": q_fan_in_ingest,
    "replay_idempotent": q_replay_idempotent,
    "run_success_counts": q_run_success_counts,
    "run_success_report": q_run_success_report,
    "prev_period": q_prev_period,
    "prev_month_end": q_prev_month_end,
    "period_type": q_period_type,
    "period_window": q_period_window,
    "daily_window": q_daily_window,
    "week_cycle": q_week_cycle,
    "blank_default": q_blank_default,
    "period_filter": q_period_filter,
    "period_refresh": q_period_refresh,
    "daily_report": q_daily_report,
    "report_lines": q_report_lines,
    "daily_report_text": q_daily_report_text,
    "gap_alert": q_gap_alert,
    "weekly_report": q_weekly_report,
    "weekly_report_text": q_weekly_report_text,
    "weekly_new_codes": q_weekly_new_codes,
    **landing_queries.QUERIES,
}

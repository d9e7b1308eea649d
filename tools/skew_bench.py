"""Skew benchmark for the offset-gap check (not a registered query).

Derives a landing table from ``lineitem`` in which one topic holds nearly all
rows and one offset is repeated for a third of them (a hot copy group), then
times the plain LEAD form (one window partition per topic) against the
bucketed form, and checks both give the same gap count.

Usage: python tools/skew_bench.py [sf_dir] [copies]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tidemark.operators.gaps import gap_count, offset_gaps_lead  # noqa: E402
from tidemark.session import get_session  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 10
    spark = get_session("local[8]", 16, app_name="tidemark-skew")
    li = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_orderkey", "l_linenumber",
                                                             "l_suppkey")
    rep = li.select("*", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("c"))
    base = rep.select(
        F.when(F.col("l_suppkey") % 50 == 0, F.lit("cold")).otherwise(F.lit("hot")).alias("topic"),
        # unique offsets with holes where line numbers are missing
        (F.col("c") * 100_000_000 + F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("off"))
    hot_copies = rep.where(F.col("l_linenumber") <= 2).select(F.lit("hot").alias("topic"),
                                                             F.lit(42).cast("long").alias("off"))
    table = base.unionByName(hot_copies)
    path = os.path.join(spark.conf.get("spark.checkpoint.dir").replace("file:", ""),
                        f"skew-bench-{os.getpid()}")
    # many files, like a real landing table (the driver tables are one row group each)
    table.repartition(16).write.mode("overwrite").parquet(path)
    df = spark.read.parquet(path)
    n = df.count()
    out = {"rows": n}
    for name, fn in [("lead_form", lambda: offset_gaps_lead(df, "off", "topic").agg(
                          F.count(F.lit(1)).alias("gap_count"))),
                     ("bucketed_form", lambda: gap_count(df, "off", "topic"))]:
        best, val = None, None
        for _ in range(2):
            t0 = time.perf_counter()
            val = fn().first()[0]
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        out[name] = {"sec": round(best, 3), "gap_count": val}
    if "--joins" in sys.argv:
        out["validity_join"] = join_skew(spark, df)
    print(json.dumps(out))
    spark.stop()


def join_skew(spark, df) -> dict:
    """Hot-key validity join: plain shuffle join, salted join, pre-aggregated count.

    Broadcasts and AQE's skew split are switched off for this measurement, so
    the hot key really lands in one task unless the operator spreads it.
    """
    from tidemark.operators.joins import validity_join, validity_join_count

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    base = F.lit("2024-01-01").cast("date")
    facts = df.select(F.col("topic").alias("person"),
                      F.date_add(base, (F.col("off") % 28).cast("int")).alias("day"))
    dim = spark.createDataFrame([("hot", "2024-01-01", "2024-01-10"), ("hot", "2024-01-08", "2024-01-31"),
                                 ("cold", "2024-01-01", "2024-01-31")],
                                "off_id string, fra string, til string") \
        .select("off_id", F.col("fra").cast("date").alias("fra"), F.col("til").cast("date").alias("til"))
    res = {}
    for name, fn in [
            ("plain", lambda: validity_join(facts, dim, "person", "off_id", "day", "fra", "til").count()),
            ("salt_16", lambda: validity_join(facts, dim, "person", "off_id", "day", "fra", "til",
                                              salt=16).count()),
            ("pre_aggregated_count", lambda: validity_join_count(facts, dim, "person", "off_id", "day",
                                                                 "fra", "til").first()[0])]:
        t0 = time.perf_counter()
        n = fn()
        res[name] = {"sec": round(time.perf_counter() - t0, 3), "rows": n}
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.skewJoin.enabled")
    return res


if __name__ == "__main__":
    main()

"""Summarise the executed physical plan of every registered query (PLANS.md).

For each key: shuffles (Exchange), broadcasts, reused exchanges, scans with
their pushed filters and read columns, joins and windows, Python evaluation.
Usage: python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.plans.catalog import QUERIES  # noqa: E402
from tidemark.session import get_session  # noqa: E402


def formatted_plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summarise(plan: str) -> dict[str, object]:
    main, _, subs = plan.partition("===== Subqueries =====")
    heads = re.findall(r"^Subquery:\d+ Hosting operator id = \d+ Hosting Expression = (\w+)",
                       subs, flags=re.M)
    n_sub = sum(h == "Subquery" for h in heads)
    n_reused_sub = sum(h == "ReusedSubquery" for h in heads)
    s = _summarise_main(main)
    s["subqueries"] = f"{n_sub}" + (f" ({n_reused_sub} reused)" if n_reused_sub else "")
    return s


def _summarise_main(plan: str) -> dict[str, object]:
    # formatted explain: a tree, then one "(n) Operator" block per node
    blocks = re.split(r"\n(?=\(\d+\) )", plan)
    tree = blocks[0].split("== Initial Plan ==")[0]
    final_ids = set(re.findall(r"\((\d+)\)\s*$", tree, flags=re.M))
    if final_ids:
        blocks = [blocks[0]] + [b for b in blocks[1:]
                                if re.match(r"\((\d+)\)", b).group(1) in final_ids]
    lines = [b.splitlines()[0] for b in blocks[1:]]
    shuffle_blocks = [b for b in blocks[1:] if re.match(r"\(\d+\) Exchange", b)]
    shuffles = [b for b in shuffle_blocks]
    scans = []
    for b in blocks[1:]:
        if re.match(r"\(\d+\) Scan ", b):
            table = re.search(r"Location: \w+ \[file:[^\]]*/([^/\]]+)\]", b)
            pushed = re.search(r"PushedFilters: \[(.*)\]", b)
            schema = re.search(r"ReadSchema: struct<(.*)>", b)
            cols = len(re.findall(r"[^,<]+?:", schema.group(1))) if schema and schema.group(1) else 0
            scans.append((table.group(1) if table else "?",
                          (pushed.group(1) if pushed else "")[:120], cols))
    joins = sorted({m.group(0) for l in lines
                    for m in [re.search(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|"
                                        r"BroadcastNestedLoopJoin|CartesianProduct)[^,]*?(Inner|LeftAnti|"
                                        r"LeftOuter|LeftSemi|RightOuter|FullOuter)?", l)] if m})
    return {
        "shuffles": len(shuffles),
        "single_partition": sum("SinglePartition" in b for b in shuffles),
        "broadcasts": sum(bool(re.match(r"\(\d+\) BroadcastExchange", b)) for b in blocks[1:]),
        "reused": sum(bool(re.match(r"\(\d+\) ReusedExchange", b)) for b in blocks[1:]),
        "windows": sum(bool(re.match(r"\(\d+\) Window", b)) for b in blocks[1:]),
        "joins": ", ".join(joins),
        "python": any(re.search(r"(ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas|"
                                r"MapInPandas)", l) for l in lines),
        "scans": scans,
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", 16, app_name="tidemark-plans",
                        extra={"spark.sql.maxMetadataStringLength": "10000"})
    print("# Executed plans of the registered queries\n")
    print(f"Generated by `tools/plan_report.py` on `{sf}` (`local[8]`, AQE on; final adaptive plans).")
    print("Shuffles count `Exchange` operators (a `SinglePartition` one follows a partial")
    print("aggregate and carries one row per map task). Scans list the table, the filters")
    print("pushed into the parquet reader and the number of columns read.\n")
    print("| Query | Shuffles | Broadcasts | Reused | Windows | Subqueries | Joins | Python | Scans (table: pushed filters; columns) |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    for k, q in QUERIES.items():
        df = q(spark, sf)
        # run this very DataFrame so explain shows its final adaptive plan
        # (dev tool; results at sf0.1 are at most ~100k rows)
        df.collect()
        s = summarise(formatted_plan(df))
        scans = "<br>".join(f"{t}: {p or '-'}; {n}" for t, p, n in s["scans"])
        print(f"| `{k}` | {s['shuffles']} ({s['single_partition']} single) | {s['broadcasts']} | "
              f"{s['reused']} | {s['windows']} | {s['subqueries']} | {s['joins'] or '-'} | {'yes' if s['python'] else 'no'} | "
              f"{scans} |")
    spark.stop()


if __name__ == "__main__":
    main()

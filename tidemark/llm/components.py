"""Connected components of a link table: union-find in tasks, then hooking joins."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged


def _local_forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over one task's links: at most one link per node, to its least peer."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for batch in batches:
        for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
            x, y = root(x), root(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
    links = [(x, root(x)) for x in parent]
    links = [(x, y) for x, y in links if x != y]
    for i in range(0, len(links), 100_000):
        x, y = zip(*links[i:i + 100_000])
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], names=["x", "y"])


def connected_components(links: DataFrame) -> DataFrame:
    """``node``, ``component`` (least node reachable) of the nodes in ``links`` (a, b).

    Each round every node hooks to its least smaller neighbour, the hooks are
    followed to their roots, and the links are rewritten to roots; rounds go on
    until no link is left.  A node of many links costs one row per task in the
    aggregates; nothing is gathered on the driver but counts.  Null ends and
    loops are ignored; no links give no rows.
    """
    links = links.filter("a <> b").select(F.greatest("a", "b").alias("x"), F.least("a", "b").alias("y"))
    links = staged(links.mapInArrow(_local_forest, "x long, y long").distinct(), "links")
    labels = staged(links.select(F.explode(F.array("x", "y")).alias("node")).distinct()
                    .withColumn("component", F.col("node")), "labels")
    while not links.isEmpty():
        hooks = staged(links.groupBy("x").agg(F.min("y").alias("to")), "hooks")
        while True:  # two jumps at a time
            once = _follow(hooks, hooks, "to")
            hooks = staged(_follow(once, once, "to").join(hooks.select("x", F.col("to").alias("was")), "x"), "hooks")
            moved = not hooks.filter("to <> was").isEmpty()
            hooks = hooks.select("x", "to")
            if not moved:
                break
        labels = staged(_follow(labels, hooks, "component"), "labels")
        links = _follow(_follow(links, hooks, "x"), hooks, "y").filter("x <> y")
        links = staged(links.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct(), "links")
    return labels


def _follow(df: DataFrame, hooks: DataFrame, col: str) -> DataFrame:
    """``df`` with the nodes in ``col`` replaced by the roots they hooked to."""
    to = hooks.select(F.col("x").alias(col), F.col("to").alias("_root"))
    rest = [c for c in df.columns if c != col]
    return df.join(to, col, "left").select(F.coalesce("_root", col).alias(col), *rest).select(*df.columns)

"""Sharding by balanced label propagation.

Equal texts are linked.  Documents start in shards by a hash of their ids, and a
group's label is the shard most of its documents are in.  Only how many groups of
each size wish for each shard reaches the driver; there, size by size from the
largest, it is decided how many of them stay at their label and how many go to
which other shard, until no group fits anywhere whole.  Linked documents may take
all seats.  Since groups of equal texts are linked to nothing else, labels are
settled after this one round.  Documents without links are then dealt to the seats
that are left, so sizes stay even.

Groups larger than a shard are cut into parts of a shard's size first.  Groups
that found no shard with room for them are spread over the fewest shards; these
are fewer than there are shards, as each takes all the room of one.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import staged, texts

#: Groups of more than this share of a shard are few, and are joined by broadcast.
LARGE = 1 / 16


def numbered(df: DataFrame, by: str, *ties: str) -> DataFrame:
    """``df`` with ``nth``: a gapless number from 0 among the rows of equal ``by``.

    Rows are numbered in the order of a hash of ``ties``, so a row's number does not
    depend on where the table keeps it.  Ranges of (``by``, hash) are sorted and counted
    one by one and their counts summed up, so a value's rows need not meet in one task
    (only rows equal in all of ``ties`` do).  ``df`` is written out first, so that rows
    stay where they were counted.
    """
    order = [F.col(by), F.xxhash64(*ties), *map(F.col, ties)]
    placed = staged(df.repartitionByRange(*order).sortWithinPartitions(*order)
                    .withColumn("_row", F.monotonically_increasing_id()), "numbered")
    task = F.shiftright("_row", 33).alias("_task")
    runs = placed.groupBy(by, task).agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy(by).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(by, "_task", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    return (placed.withColumn("_task", F.shiftright("_row", 33)).join(runs, [by, "_task"])
            .withColumn("nth", F.col("_base") + F.col("_row") - F.col("_first")).drop("_task", "_row", "_first", "_base"))


Dealt = list[tuple[int, int]]


def _plan(classes: dict[tuple[int, int], int], seats: list[int], stay: bool) -> tuple[dict, dict, list[int]]:
    """Where the units go: for each (size, label) how many go to which shard, the shards
    and shares of each unit that fits nowhere whole, and the seats left.

    ``stay``: units stay at their label while there is room, else all go to the
    fullest shard that holds them.
    """
    room, whole, late = list(seats), defaultdict(list), []
    sizes: dict[int, dict[int, int]] = defaultdict(dict)
    for (n, label), count in classes.items():
        sizes[n][label] = count
    for n in sorted(sizes, reverse=True):
        left = dict(sorted(sizes[n].items()))

        def put(label: int, shard: int) -> None:
            k = min(left[label], room[shard] // n)
            if k:
                whole[n, label].append((shard, k))
                room[shard] -= k * n
                left[label] -= k

        if stay:
            for label in left:
                put(label, label)
        for label in left:
            while left[label] and max(room) >= n:
                put(label, min((r, s) for s, r in enumerate(room) if r >= n)[1])
            late += [(n, label)] * left[label]
    parts: dict[tuple[int, int], list[Dealt]] = defaultdict(list)
    for n, label in late:
        dealt: Dealt = []
        while n_left := n - sum(k for _, k in dealt):
            fits = [(r, s) for s, r in enumerate(room) if r >= n_left]
            shard = min(fits)[1] if fits else room.index(max(room))
            dealt.append((shard, min(n_left, room[shard])))
            room[shard] -= dealt[-1][1]
        parts[n, label].append(dealt)
    return whole, parts, room


def _ends(dealt: Dealt) -> tuple[list[int], list[int]]:
    """The shards, and the running totals of what they get."""
    ends, n = [], 0
    for _, k in dealt:
        n += k
        ends.append(n)
    return [s for s, _ in dealt], ends


def _settle(units: DataFrame, seats: list[int]) -> tuple[DataFrame, DataFrame, list[int]]:
    """``unit``, ``large``, ``shard`` of the units (``unit``, ``n``, ``large``, ``label``) that stay
    whole; ``unit``, ``to``, ``ends`` of the others; and the seats left."""
    spark = units.sparkSession
    classes = {(r["n"], r["label"]): r["count"] for r in units.groupBy("n", "label").count().collect()}
    # what holds most units whole decides, then what moves fewer of them
    plans = [_plan(classes, seats, stay) for stay in (True, False)]
    whole, parts, room = min(plans, key=lambda p: sum(len(x) for x in p[1].values()))
    table = spark.createDataFrame([(n, label, *_ends(whole.get((n, label), []))) for n, label in classes],
                                  "n long, label int, to array<int>, ends array<long>")
    placed = numbered(units.withColumn("class", F.struct("n", "label")), "class", "unit").drop("class").join(
        F.broadcast(table), ["n", "label"])
    placed = placed.withColumn("k", F.size(F.filter("ends", lambda e: e <= F.col("nth"))))
    placed = staged(placed.select("unit", "n", "large", "label", F.get("to", "k").alias("shard")), "placed")
    late = []
    for r in placed.filter("shard IS NULL").orderBy("unit").collect():
        late.append((r["unit"], *_ends(parts[r["n"], r["label"]].pop())))
    late = spark.createDataFrame(late, "unit long, to array<int>, ends array<long>")
    return placed.filter("shard IS NOT NULL").select("unit", "large", "shard"), late, room


def shard_documents(docs: DataFrame, shards: int = 40) -> DataFrame:
    """Put documents into ``shards`` shards with counts at most one apart (law ``rows``).

    Equal texts are kept in one shard; a group larger than a shard is cut into
    parts of a shard's size.  Groups and parts are placed largest first, and one
    that then fits into no shard whole is spread over the fewest.  Returns one row
    per input row: ``doc_id``, ``size`` (UTF-8 bytes of the text plus 16),
    ``text_crc32``, ``law``, ``shard``, ``slot`` (gapless from 0 within the
    shard) and ``grown_shard`` (null: counts decide, not keys).  Shards and slots
    follow from the rows alone, not from the table's files or partitions.

    Null text counts as empty.  Every row is a document, with repeated or null
    ids too.  No rows give no rows.  Extra columns are ignored.
    """
    raw = F.col("text").cast("binary")
    rows = staged(texts(docs).select(
        "doc_id", (F.octet_length(raw) + 16).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"),
        F.unhex(F.md5(raw)).alias("key")), "sized")
    total = rows.count()
    seats = [total // shards + (1 if s < total % shards else 0) for s in range(shards)]
    quota, part = max(seats), max(total // shards, 1)  # a part has room in any shard
    counts = staged(rows.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "counts")
    big = F.col("n") > int(part * LARGE)
    # the few large groups are looked up where the rows are, so that no group's rows meet in one task
    rows = rows.join(F.broadcast(counts.filter(big).withColumnRenamed("n", "n_large")), "key", "left")
    rest = rows.filter("n_large IS NULL").join(counts.filter(~big), "key", "left")
    judged = staged(rest.unionByName(rows.filter("n_large IS NOT NULL").withColumn("n", F.col("n_large"))), "judged")
    alone = judged.filter("n IS NULL").select("doc_id", "size", "text_crc32")
    cut = numbered(judged.filter(F.col("n") > quota), "key", "doc_id")
    linked = judged.filter(F.col("n") <= quota).withColumn("part", F.lit(0).cast("long")).unionByName(
        cut.withColumn("part", F.floor(F.col("nth") / part)).drop("nth"))
    linked = staged(linked.select(
        "doc_id", "size", "text_crc32", F.xxhash64("key", "part").alias("unit"), F.col("n_large").isNotNull().alias("large"),
        F.pmod(F.xxhash64("doc_id", F.lit("start")), F.lit(shards)).cast("int").alias("start")), "linked")
    units = linked.groupBy("unit", "large", "start").agg(F.count("*").alias("n")).groupBy("unit", "large").agg(
        F.sum("n").alias("n"), F.max_by("start", F.struct("n", "start")).alias("label"))
    settled, late, room = _settle(staged(units, "units"), seats)
    place = linked.filter("large").join(F.broadcast(settled.filter("large").drop("large")), "unit").unionByName(
        linked.filter("NOT large").join(settled.filter("NOT large").drop("large"), "unit"))
    parted = numbered(linked.join(F.broadcast(late.select("unit")), "unit", "left_semi"), "unit", "doc_id").join(
        F.broadcast(late), "unit")
    parted = parted.withColumn("shard", F.get("to", F.size(F.filter("ends", lambda e: e <= F.col("nth")))))
    columns = ["doc_id", "size", "text_crc32", "shard"]
    kept = numbered(place.select(*columns).unionByName(parted.select(*columns)), "shard", *columns[:3]).withColumnRenamed("nth", "slot")
    spread = numbered(alone.withColumn("all", F.lit(0)), "all", *columns[:3])
    # seats left, shard after shard: the k-th free document takes the k-th of them
    free, ends = 0, []
    for s in range(shards):
        free += room[s]
        ends.append(free)
    upto = F.array(*[F.lit(e).cast("long") for e in ends])
    to = F.size(F.filter(upto, lambda e: e <= F.col("nth"))).alias("shard")
    slot = F.col("nth") - F.get(F.array(*[F.lit(e).cast("long") for e in [0, *ends[:-1]]]), F.col("shard")) \
        + F.get(F.array(*[F.lit(seats[s] - room[s]).cast("long") for s in range(shards)]), F.col("shard"))
    dealt = spread.select("doc_id", "size", "text_crc32", to, "nth").withColumn("slot", slot).drop("nth")
    return kept.unionByName(dealt).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op10(spark, docs: DataFrame) -> DataFrame:
    """``shard_documents`` into 40 shards."""
    return shard_documents(docs, 40)

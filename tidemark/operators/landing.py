"""Landing tables: each run's rows are appended once, and the files' keys are indexed.

A run is named by its writer (a streaming query's id, a slice) and its number (the
micro-batch).  An append goes through the table's own folders, which readers skip:

1. the rows are written to ``_ledger/<writer>/<number>.new``; the table has not changed;
2. an index of the new files' keys is written beside them;
3. the names of the files are written to ``_ledger/<writer>/<number>.json`` (one small
   file, there as a whole or not at all): from here on the append is decided;
4. the files are moved into the table, then the index, and the entry becomes ``.done``.

A run that stops before step 3 leaves the table as it was and starts anew when it
is repeated.  A run that is repeated later finds its entry: what is left of step 4 is
done, and nothing is appended again, whatever the rows' keys are.  ``read_landing``
does the same for every decided append.  The names of a run's files come from its
own folder, so no append lists the table, and writers do not see each other's files.

The index holds for each file and topic the range of offsets, and for each file a
Bloom filter of its keys (bit maps made by Spark aggregates).  ``candidate_files``
joins a batch's keys with it, so that a duplicate check reads the files that may hold
a key, not the table.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.session import (data_files, delete_path, hadoop_fs, list_names, path_exists, read_text, rename_path,
                              write_text)

LEDGER, INDEX = "_ledger", "_index"
#: File that names the keys (with types) of which the index holds every file of the table.
INDEXED = f"{LEDGER}/indexed"
#: Writer of runs that are never repeated; their entries go when they are done.
ONCE = "once"
#: Done entries of a writer that are kept (a stream repeats its last number only).
KEEP = 100
#: Bloom filter: bits per key, hashes per key; bits of one bit map of Spark (fixed).
BITS_PER_KEY, HASHES, MAP_BITS = 10, 4, 1 << 15
#: Bits of a word, as which a filter is gathered (a long).
WORD = 64
#: Files whose ranges a batch meets for which it is cheaper to ask the filters than to read the files' keys.
PROBE_FROM = 64
#: Offsets of a batch are compared with the files' ranges in bins of this width.
BIN = 1 << 12
_INDEX_SCHEMA = ("file string, topic string, lo long, hi long, n long, bits long, part long, map binary")


class Run(NamedTuple):
    """Name of one append: of equal runs only the first appends."""

    writer: str
    number: int | str

    @staticmethod
    def once() -> Run:
        """A run that is never repeated."""
        return Run(ONCE, uuid.uuid4().hex)

    @property
    def path(self) -> str:
        safe = re.compile(r"[^A-Za-z0-9.-]")
        writer, number = (safe.sub(lambda m: f"%{ord(m[0]):x}", str(x)) for x in self)
        return f"{writer}/{number}"


def _entry(spark: SparkSession, target: str, run: Run) -> dict | None:
    for end in (".done", ".json"):
        if path_exists(spark, f"{target}/{LEDGER}/{run.path}{end}"):
            return json.loads(read_text(spark, f"{target}/{LEDGER}/{run.path}{end}"))
    return None


def _publish(spark: SparkSession, target: str, path: str) -> None:
    """Step 4 of the append with the decided entry at ``path``; parts of it may be done."""
    work = f"{target}/{LEDGER}/{path}"
    if not path_exists(spark, f"{work}.json"):
        return
    for name in json.loads(read_text(spark, f"{work}.json"))["files"]:
        fs, p = hadoop_fs(spark, f"{target}/{name}")
        if not fs.exists(p):
            fs.mkdirs(p.getParent())
            rename_path(spark, f"{work}.new/{name}", f"{target}/{name}")
    if path_exists(spark, f"{work}.index"):
        fs, p = hadoop_fs(spark, f"{target}/{INDEX}")
        fs.mkdirs(p)
        rename_path(spark, f"{work}.index", f"{target}/{INDEX}/{path.replace('/', '-')}")
    delete_path(spark, f"{work}.new")
    rename_path(spark, f"{work}.json", f"{work}.done")


def _forget(spark: SparkSession, target: str, run: Run) -> None:
    """Drop the entries that will not be asked for: of nameless runs, and of numbers that
    a stream has long passed."""
    if run.writer == ONCE:
        delete_path(spark, f"{target}/{LEDGER}/{run.path}.done")
        return
    writer = run.path.split("/")[0]
    done = [int(n[:-5]) for n, _ in list_names(spark, f"{target}/{LEDGER}/{writer}") if re.fullmatch(r"\d+\.done", n)]
    for n in sorted(done)[:-KEEP]:
        delete_path(spark, f"{target}/{LEDGER}/{writer}/{n}.done")


def finish_appends(spark: SparkSession, target: str) -> None:
    """Finish every decided append of the table."""
    for writer, is_folder in list_names(spark, f"{target}/{LEDGER}"):
        if is_folder:
            for name, _ in list_names(spark, f"{target}/{LEDGER}/{writer}"):
                if name.endswith(".json"):
                    _publish(spark, target, f"{writer}/{name[:-5]}")


def read_landing(spark: SparkSession, target: str, schema: StructType | str,
                 files: Sequence[str] | None = None) -> DataFrame:
    """The landing table, or the rows of some of its files, in the schema given (so
    partition columns keep their types); decided appends are finished first."""
    target = target.rstrip("/")
    finish_appends(spark, target)
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    reader = spark.read.schema(schema)
    if files is None:
        rows = reader.parquet(target)
    elif files:
        rows = reader.option("basePath", target).parquet(*[f"{target}/{f}" for f in files])
    else:
        rows = spark.createDataFrame([], schema)
    return rows.select(*[f"`{c}`" for c in schema.names])


def appended(spark: SparkSession, target: str, run: Run, schema: StructType) -> DataFrame | None:
    """The rows that ``run`` has appended, None if it has not."""
    target = target.rstrip("/")
    entry = _entry(spark, target, run)
    if entry is None:
        return None
    _publish(spark, target, run.path)
    return read_landing(spark, target, schema, entry["files"])


def append_once(df: DataFrame, target: str, run: Run, partition_by: Sequence[str] = (),
                keys: Sequence[str] = (), offset: str | None = None, topic: str | None = None) -> DataFrame:
    """Append the rows of ``df`` unless ``run`` has done so; the rows that ``run`` appended.

    With ``keys`` the new files are indexed: by the ranges of ``offset`` per ``topic``
    and a Bloom filter of the keys.  Rows with a NULL key are not in the index, since
    they equal no other row.
    """
    spark, target = df.sparkSession, target.rstrip("/")
    before = appended(spark, target, run, df.schema)
    if before is not None:
        return before
    _keep_index_whole(df, target, keys if offset in keys else ())
    work = f"{target}/{LEDGER}/{run.path}"
    for left in (".new", ".index"):
        delete_path(spark, work + left)
    w = df.write
    (w.partitionBy(*partition_by) if partition_by else w).parquet(f"{work}.new")
    files = data_files(spark, f"{work}.new")
    if keys and files and offset in keys:
        new = spark.read.schema(df.schema).parquet(f"{work}.new")
        _index(new, f"{work}.new", keys, offset, topic).write.parquet(f"{work}.index")
    write_text(spark, f"{work}.json", json.dumps({"files": files}))
    _publish(spark, target, run.path)
    _forget(spark, target, run)
    return read_landing(spark, target, df.schema, files)


# ---------------------------------------------------------------- index

def _key_types(df: DataFrame, keys: Sequence[str]) -> str:
    types = dict(df.dtypes)
    return json.dumps([[k, types[k]] for k in sorted(keys)])


def _holds_data(spark: SparkSession, target: str) -> bool:
    return any(not n.startswith(("_", ".")) for n, _ in list_names(spark, target))


def _keep_index_whole(df: DataFrame, target: str, keys: Sequence[str]) -> None:
    """Before an append: a new table is indexed by the keys from its first file on; an index
    by other keys is no longer whole."""
    spark, named = df.sparkSession, _key_types(df, keys)
    if path_exists(spark, f"{target}/{INDEXED}"):
        if read_text(spark, f"{target}/{INDEXED}") != named:
            delete_path(spark, f"{target}/{INDEXED}")
    elif keys and not path_exists(spark, f"{target}/{LEDGER}") and not _holds_data(spark, target):
        write_text(spark, f"{target}/{INDEXED}", named)


def index_table(spark: SparkSession, target: str, schema: StructType | str, keys: Sequence[str], offset: str,
                topic: str | None = None) -> None:
    """Index a table from its files (one that was filled past the ledger, or by other keys)."""
    target = target.rstrip("/")
    rows = read_landing(spark, target, schema)
    for left in (INDEX, INDEXED):
        delete_path(spark, f"{target}/{left}")
    if _holds_data(spark, target):
        _index(rows, target, keys, offset, topic).write.parquet(f"{target}/{INDEX}/table")
    write_text(spark, f"{target}/{INDEXED}", _key_types(rows, keys))


def _places(keys: Sequence[str], bits: Column) -> Column:
    """Bits of a key in a filter of ``bits`` bits."""
    a, b = F.xxhash64(*keys), F.xxhash64(F.lit(1), *keys)
    step = F.pmod(b, bits - 1) + 1
    return F.array(*[F.pmod(F.pmod(a, bits) + F.lit(i) * step, bits) for i in range(HASHES)])


def _index(rows: DataFrame, root: str, keys: Sequence[str], offset: str, topic: str | None) -> DataFrame:
    """Index rows of files below ``root``: a row for each file and topic, and one for
    each bit map of the file's filter (``part`` from 1).

    Hash aggregates bring a task's keys down to words of ``WORD`` bits before any are
    moved: neither a batch nor a file is sorted, or gathered in one task.
    """
    p = hadoop_fs(rows.sparkSession, root)[1].toUri().getPath()
    path = F.regexp_extract("_path", f"^.*?{re.escape(p)}/(.*)$", 1)
    name = F.expr("url_decode(replace(_file, '+', '%2B'))")
    topic_col = F.col(topic).cast("string") if topic in keys else F.lit(None).cast("string")
    own = rows.select(F.col("_metadata.file_path").alias("_path"), *keys, topic_col.alias("topic")).dropna(subset=list(keys))
    ranges = own.groupBy("_path", "topic").agg(F.min(offset).alias("lo"), F.max(offset).alias("hi"), F.count("*").alias("n"))
    ranges = ranges.withColumn("_file", path).withColumn("file", name)
    # one row for each file that was written
    n = F.col("n")
    bits = F.lit(MAP_BITS) * F.pow(F.lit(2), F.ceil(F.log2(F.greatest(n * BITS_PER_KEY / MAP_BITS, F.lit(1))))).cast("long")
    files = ranges.groupBy("_path", "file").agg(F.sum("n").alias("n")).select("_path", "file", bits.alias("bits"))
    place = F.col("place")
    words = (own.join(F.broadcast(files), "_path")
             .select("file", "bits", F.explode(_places(keys, F.col("bits"))).alias("place"))
             .groupBy("file", "bits", F.floor(place / WORD).alias("word")).agg(F.bit_or(_bit(place)).alias("word_bits")))
    per_map = MAP_BITS // WORD
    maps = (words.groupBy("file", "bits", (F.floor(F.col("word") / per_map) + 1).alias("part"))
            .agg(F.sort_array(F.collect_list(F.struct(F.pmod("word", F.lit(per_map)).cast("int").alias("at"), "word_bits"))).alias("words"))
            .withColumn("map", _bit_map(F.col("words"), per_map)))
    order = [c.split()[0] for c in _INDEX_SCHEMA.split(", ")]
    return ranges.drop("_path", "_file").unionByName(maps, allowMissingColumns=True).select(*order).hint("rebalance", "file")


def _bit(place: Column) -> Column:
    """The place's bit in its word; a word's bytes stand in the order of its hex digits."""
    at = F.pmod(place, F.lit(WORD)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.lit(WORD - 8) - F.floor(at / 8).cast("int") * 8 + F.pmod(at, F.lit(8)))


def _bit_map(words: Column, per_map: int) -> Column:
    """The bytes of a bit map from its words in order; words that are not there are zeros."""
    digits = WORD // 4

    def after_gap(x: Column, i: Column) -> Column:
        last = F.when(i > 0, F.get(words, i - 1)["at"]).otherwise(F.lit(-1))
        return F.concat(F.repeat(F.lit("0"), (x["at"] - last - 1) * digits), F.lpad(F.hex(x["word_bits"]), digits, "0"))

    return F.unhex(F.rpad(F.array_join(F.transform(words, after_gap), ""), per_map * digits, "0"))


def read_index(spark: SparkSession, target: str, like: DataFrame, keys: Sequence[str]) -> DataFrame | None:
    """The table's index by the keys, None if it does not hold every file."""
    mark = f"{target.rstrip('/')}/{INDEXED}"
    if not path_exists(spark, mark) or read_text(spark, mark) != _key_types(like, keys):
        return None
    folder = f"{target.rstrip('/')}/{INDEX}"
    if not path_exists(spark, folder):
        return spark.createDataFrame([], _INDEX_SCHEMA)
    return spark.read.schema(_INDEX_SCHEMA).option("recursiveFileLookup", "true").parquet(folder)


def _may_hold(maps: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(maps, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, F.pmod(place, F.lit(8)).cast("int")) == 1


def candidate_files(spark: SparkSession, target: str, batch: DataFrame, keys: Sequence[str], offset: str,
                    topic: str | None = None) -> list[str] | None:
    """Files of the table that may hold one of the batch's keys; None without an index.

    The batch's offsets meet the files' ranges in bins, per topic; if more than a few
    files are left, the keys of a bin then meet these files' filters.  What comes to
    the driver are the names of files.
    """
    index = read_index(spark, target, batch, keys)
    if index is None:
        return None
    topic_col = F.col(topic).cast("string") if topic in keys else F.lit(None).cast("string")
    own = batch.select(*keys, topic_col.alias("_topic")).dropna(subset=list(keys))
    own = own.withColumn("_bin", F.expr(f"`{offset}` div {BIN}"))
    bins = own.select("_topic", "_bin").distinct()
    ranges = index.where("part IS NULL").select("file", "topic", "lo", "hi")
    near = bins.join(ranges, F.col("_topic").eqNullSafe(F.col("topic"))
                     & F.expr(f"_bin BETWEEN lo div {BIN} AND hi div {BIN}")).select("_topic", "_bin", "file", "lo", "hi")
    found = sorted(r["file"] for r in near.select("file").distinct().collect())
    if len(found) < PROBE_FROM:
        return found
    maps = index.where("part IS NOT NULL").select("file", "bits", "part", "map")
    sizes = maps.select("file", "bits").distinct()
    asked = (own.withColumnRenamed("_topic", "_t").withColumnRenamed("_bin", "_b").join(
        near, F.col("_t").eqNullSafe(F.col("_topic")) & (F.col("_b") == F.col("_bin")) & F.col(offset).between(F.col("lo"), F.col("hi")))
        .join(sizes, "file"))
    asked = asked.select("file", F.xxhash64(*keys).alias("_key"), F.explode(_places(keys, F.col("bits"))).alias("_place"))
    asked = asked.withColumn("part", F.bitmap_bucket_number(F.col("_place") + 1))
    hits = asked.join(maps.drop("bits"), ["file", "part"], "left")
    held = F.coalesce(_may_hold(F.col("map"), F.bitmap_bit_position(F.col("_place") + 1)), F.lit(False))
    files = hits.groupBy("file", "_key").agg(F.bool_and(held).alias("_all")).where("_all").select("file").distinct()
    return sorted(r["file"] for r in files.collect())


__all__ = ["Run", "append_once", "appended", "finish_appends", "read_landing", "index_table", "read_index",
           "candidate_files"]

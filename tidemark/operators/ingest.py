"""Config-driven ingest of message envelopes into landing tables.

An *envelope* DataFrame has the columns of a consumed message:
``kafka_message, kafka_topic, kafka_offset, kafka_timestamp (epoch ms),
kafka_partition`` and optionally ``kafka_hash``.  An :class:`IngestSpec` lists
``src -> dst`` field maps that are lowered to one ``select``:

* ``kafka_*`` names copy an envelope column;
* ``$TEXT`` is the literal ``TEXT``;
* ``$$$BATCH_TIME`` is the batch time (one value per batch, an argument);
* any other name is a key (``a/b`` for nested keys) read from the JSON payload;
* ``fun: int-unix-ms -> datetime-no`` turns epoch ms into Oslo wall-clock time.

Duplicates are skipped against the target on the spec's key columns.
"""

from __future__ import annotations

import dataclasses
import datetime as _dt
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.json import json_key
from tidemark.functions.timez import ts_literal, unix_ms_to_local
from tidemark.operators.landing import Run, append_once, appended, candidate_files, finish_appends, read_landing
from tidemark.session import hadoop_fs, path_exists

# Fixed values of the consumer-spec format (they must equal the existing specs):
#   envelope columns: kafka_message, kafka_topic, kafka_offset, kafka_timestamp,
#                     kafka_partition, kafka_hash
#   batch-time token: $$$BATCH_TIME ; literal prefix: $
#   the only field function: "int-unix-ms -> datetime-no", local zone Europe/Oslo
ENVELOPE_COLUMNS = ("kafka_message", "kafka_topic", "kafka_offset", "kafka_timestamp",
                    "kafka_partition", "kafka_hash")
BATCH_TIME = "$$$BATCH_TIME"
FUN_UNIX_MS_LOCAL = "int-unix-ms -> datetime-no"
LOCAL_ZONE = "Europe/Oslo"


@dataclasses.dataclass(frozen=True)
class FieldMap:
    src: str
    dst: str
    fun: str | None = None


@dataclasses.dataclass(frozen=True)
class IngestSpec:
    """Source, target and field maps of one consumer."""

    topic: str | None
    table: str
    transform: tuple[FieldMap, ...]
    skip_duplicates_with: tuple[str, ...] = ()
    batch_size: int | None = None
    batch_interval: int | None = None
    group_id: str | None = None
    keypath_separator: str = "/"
    message_type: str = "string"   # "string" (CLOB) or "binary" (BLOB)

    @staticmethod
    def from_dict(d: Mapping[str, Any], topic: str | None = None) -> "IngestSpec":
        src = d.get("source", {}) or {}
        tgt = d.get("target", {}) or {}
        # the column that takes the payload, under whatever name, may be bound as BLOB
        payload = {str(x["dst"]) for x in d.get("transform", []) if x.get("src") == "kafka_message"}
        bound = {str(c.get("name")): str(c.get("value", "")).upper() for c in tgt.get("custom-config", []) or []}
        msg_type = "binary" if any("BLOB" in bound.get(c, "") for c in payload) else "string"
        t = src.get("topic")
        if topic is not None:
            t = topic
        # an unfilled "{}" placeholder (YAML reads it as an empty mapping) means no topic yet
        unfilled = t is None or t == "{}" or (isinstance(t, dict) and not t)
        return IngestSpec(
            topic=None if unfilled else str(t),
            table=str(tgt.get("table", "")),
            transform=tuple(FieldMap(str(x["src"]), str(x["dst"]), x.get("fun"))
                            for x in d.get("transform", [])),
            skip_duplicates_with=tuple(tgt.get("skip-duplicates-with", []) or []),
            batch_size=src.get("batch-size"),
            batch_interval=src.get("batch-interval"),
            group_id=src.get("group-id"),
            keypath_separator=str(src.get("keypath-seperator", src.get("keypath-separator", "/"))),
            message_type=msg_type,
        )

    @staticmethod
    def from_yaml(text: str, topic: str | None = None) -> "IngestSpec":
        import yaml  # optional dependency, only for YAML specs
        return IngestSpec.from_dict(yaml.safe_load(text), topic=topic)

    def dedupe_keys(self) -> list[str]:
        """Target columns for the duplicate check (spec names mapped through the transform)."""
        rename = {f.src: f.dst for f in self.transform}
        return [rename.get(k, k) for k in self.skip_duplicates_with]

    @property
    def columns(self) -> list[str]:
        return [f.dst for f in self.transform]


def field_column(f: FieldMap, spec: IngestSpec, batch_time: _dt.datetime | None,
                 available: Sequence[str] | None = None) -> Column:
    """The Column for one field map.

    ``kafka_hash`` is passed through when the envelope has it; otherwise it is
    SHA-256 of the message bytes (our choice; the original algorithm is not
    documented).
    """
    if f.src == "kafka_hash" and available is not None and "kafka_hash" not in available:
        return F.sha2(F.col("kafka_message").cast("binary"), 256).alias(f.dst)
    if f.src == BATCH_TIME:
        if batch_time is None:
            raise ValueError("batch_time is required by this spec")
        col = ts_literal(batch_time)
    elif f.src.startswith("$"):
        col = F.lit(f.src[1:])
    elif f.src in ENVELOPE_COLUMNS:
        col = F.col(f.src)
        if f.src == "kafka_message":
            col = col.cast(spec.message_type)
    else:
        col = json_key(F.col("kafka_message").cast("string"), f.src, spec.keypath_separator)
    if f.fun is not None:
        if f.fun.strip() != FUN_UNIX_MS_LOCAL:
            raise ValueError(f"unknown field function {f.fun!r}")
        col = unix_ms_to_local(col, LOCAL_ZONE)
    return col.alias(f.dst)


def apply_spec(envelope: DataFrame, spec: IngestSpec,
               batch_time: _dt.datetime | None = None) -> DataFrame:
    """Lower the spec's field maps to one projection of the envelope."""
    cols = envelope.columns
    return envelope.select(*[field_column(f, spec, batch_time, cols) for f in spec.transform])


def _in_batch_range(target: DataFrame, incoming: DataFrame, keys: Sequence[str], offset_col: str | None,
                    topic_col: str | None) -> DataFrame:
    """Target rows within the batch's offset range, per topic if topic is a key.

    The ranges are an aggregate of the batch inside the plan, one row per topic
    whatever their number; with topic as the target's partition column only the
    batch's topics are read.
    """
    if not offset_col or offset_col not in keys:
        return target
    ends = [F.min(offset_col).alias("_lo"), F.max(offset_col).alias("_hi")]
    if topic_col and topic_col in keys:
        ranges = incoming.groupBy(F.col(topic_col).alias("_topic")).agg(*ends)
        return target.join(ranges, (F.col(topic_col) == F.col("_topic"))
                           & F.col(offset_col).between(F.col("_lo"), F.col("_hi")), "left_semi")
    lo, hi = (incoming.agg(e).scalar() for e in ends)
    return target.where(F.col(offset_col).between(lo, hi))


def skip_duplicates(incoming: DataFrame, target: DataFrame | None, keys: Sequence[str],
                    offset_col: str | None = "kafka_offset",
                    topic_col: str | None = "kafka_topic") -> DataFrame:
    """Incoming rows whose key is neither repeated in the batch nor already in the target.

    The target only grows; before the anti join it is cut to the offset range of
    the batch, per topic (``offset_col=None``: the target is cut already).  An empty
    key list appends everything (one consumer has no duplicate check).  Rows with a
    NULL in their key match nothing and are all kept; a repeated run is told by its
    name instead (``landing``).  Such rows get a key of their own, so the batch is
    read once for its rows and once for its ranges.
    """
    keys = list(keys)
    if not keys:
        return incoming
    whole = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))
    own = F.when(~whole, F.monotonically_increasing_id())
    batch = incoming.withColumn("_own", own).dropDuplicates([*keys, "_own"]).drop("_own")
    if target is not None:
        tgt = target.select(*keys)
        if offset_col:
            tgt = _in_batch_range(tgt, incoming.where(whole), keys, offset_col, topic_col)
        batch = batch.join(tgt, keys, "left_anti")
    return batch.select(*incoming.columns)


def ingest_batch(spark: SparkSession, spec: IngestSpec, envelope: DataFrame, target_path: str,
                 batch_time: _dt.datetime | None = None, partition_by: Sequence[str] | None = None,
                 dedupe_keys: Sequence[str] | None = None, run: Run | None = None) -> DataFrame:
    """Map one batch, drop duplicates against the target and append it.

    Returns the appended rows, read back from the files that were written.
    Reruns of the same slice append nothing, so retries after a lost executor or
    a failed run are safe.  The envelope is read once: the batch is kept while
    its ranges and its rows are used (a lost block is read again).

    ``run``: the name of this append, such as a slice's.  A run that has appended
    once never does again, also without keys and for rows with a NULL key; what it
    appended is returned.

    ``partition_by``: folders of a new landing table, by default its topics; an
    existing table keeps its own layout.
    """
    mapped = apply_spec(envelope, spec, batch_time)
    keys = list(dedupe_keys) if dedupe_keys is not None else spec.dedupe_keys()
    return _append_new(spark, mapped, target_path, keys, partition_by, run)


def _layout(spark: SparkSession, target_path: str, columns: Sequence[str],
            asked: Sequence[str] | None) -> list[str]:
    """Partition columns: the existing table's, else those asked for, else the topic."""
    fs, at = hadoop_fs(spark, target_path)
    found, empty = [], True
    while fs.exists(at):
        below = [x for x in fs.listStatus(at) if not x.getPath().getName().startswith(("_", "."))]
        empty = empty and not below
        inner = [x.getPath() for x in below if x.isDirectory() and "=" in x.getPath().getName()]
        if not inner:
            break
        found.append(inner[0].getName().split("=", 1)[0])
        at = inner[0]
    if not empty:
        return found
    return list(asked) if asked is not None else [c for c in ("kafka_topic",) if c in columns]


def _landed(spark: SparkSession, target_path: str, batch: DataFrame, keys: Sequence[str]) -> DataFrame | None:
    """What the batch is compared with: the table's files that may hold one of its keys,
    the table cut to the batch's ranges if it has no such index, None if it is empty."""
    if not keys or not path_exists(spark, target_path):
        return None
    offset = "kafka_offset" if "kafka_offset" in keys else None
    topic = "kafka_topic" if "kafka_topic" in keys else None
    finish_appends(spark, target_path)
    files = candidate_files(spark, target_path, batch, keys, offset, topic) if offset else None
    if files is not None:
        return read_landing(spark, target_path, batch.schema, files) if files else None
    return _in_batch_range(read_landing(spark, target_path, batch.schema), batch, keys, offset, topic)


def _append_new(spark: SparkSession, mapped: DataFrame, target_path: str, keys: Sequence[str],
                partition_by: Sequence[str] | None, run: Run | None) -> DataFrame:
    """Append the rows that are new and return them.

    Rows of a topic come together in few tasks (a large topic is split by size)
    and are sorted by (topic, partition, offset) inside each file, so files are
    neither tiny nor wide in their min/max statistics.
    """
    run = run or Run.once()
    before = appended(spark, target_path, run, mapped.schema)
    if before is not None:
        return before.select(*mapped.columns)
    parts = _layout(spark, target_path, mapped.columns, partition_by)
    mapped.persist()
    try:
        out = skip_duplicates(mapped, _landed(spark, target_path, mapped, keys), keys, offset_col=None)
        near = [c for c in ("kafka_topic",) if c in out.columns] or parts
        out = out.hint("rebalance", *near) if near else out
        order = [c for c in ("kafka_topic", "kafka_partition", "kafka_offset") if c in out.columns]
        out = out.sortWithinPartitions(*order) if order else out
        new = append_once(out, target_path, run, parts, keys, "kafka_offset", "kafka_topic")
    finally:
        mapped.unpersist()
    return new.select(*mapped.columns)


def ingest_many(spark: SparkSession, parts: Sequence[tuple[IngestSpec, DataFrame]], target_path: str,
                batch_time: _dt.datetime | None = None, partition_by: Sequence[str] | None = None,
                dedupe_keys: Sequence[str] | None = None, run: Run | None = None) -> DataFrame:
    """Fan-in: several specs (one per topic) into one shared target in one job.

    Each envelope is mapped by its own spec; the results are unioned by column
    name (the specs must produce the same columns), checked for duplicates once
    and appended once (``run``: as in ``ingest_batch``).
    """
    if not parts:
        raise ValueError("nothing to ingest")
    mapped = None
    for spec, env in parts:
        m = apply_spec(env, spec, batch_time)
        mapped = m if mapped is None else mapped.unionByName(m)
    keys = list(dedupe_keys) if dedupe_keys is not None else parts[0][0].dedupe_keys()
    return _append_new(spark, mapped, target_path, keys, partition_by, run)


__all__ = ["FieldMap", "IngestSpec", "apply_spec", "skip_duplicates", "ingest_batch", "ingest_many",
           "field_column", "ENVELOPE_COLUMNS", "BATCH_TIME", "FUN_UNIX_MS_LOCAL"]

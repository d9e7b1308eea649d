"""Spark-side helpers shared by the operators of this subpackage."""

from __future__ import annotations

import atexit
import gc
import tempfile
import time
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import delete_path, ensure_checkpoint_dir

#: Compressed input bytes that one bucket of a distributed sort or count takes.
BUCKET_BYTES = 10_000_000

_roots: dict[str, str] = {}
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's code to the executors, once per application.

    Needed where the package is not installed on them: functions that run in
    tasks are found there by their module's name.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp()) / f"{package.name}.zip"  # read by the driver's own file server only
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(path))
    _shipped.add(app)


def stage_root(spark: SparkSession) -> str:
    """Folder of this application below the shared checkpoint folder.

    It is removed when the Python process ends, since the tables in it are read
    by result frames that may be evaluated at any time before.
    """
    app = spark.sparkContext.applicationId
    if app not in _roots:
        _roots[app] = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tidemark-llm/{app}"
        atexit.register(_remove, spark, _roots[app])
    return _roots[app]


def _remove(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is not None:  # stopped sessions keep their files
        delete_path(spark, path)


def staged(df: DataFrame, name: str, release: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back (cuts lineage).

    ``release``: then let go of the shuffle files behind ``df``.  Spark removes
    them when the driver's garbage collector finds their plan unused, which may
    be long after; a collection here keeps the disk at one step's shuffles.
    """
    path = f"{stage_root(df.sparkSession)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    if release:
        del df
        for _ in range(2):  # listeners hold the finished plan for a moment
            time.sleep(0.4)
            gc.collect()
            out.sparkSession.sparkContext._jvm.System.gc()
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id`` (long), ``text`` (null: empty) and the columns named in ``more``."""
    doc_id = F.col("doc_id")
    if docs.schema["doc_id"].dataType != T.LongType():  # an alias of its own would keep exchanges from being reused
        doc_id = doc_id.cast("long").alias("doc_id")
    return docs.select(doc_id, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *more)


def n_buckets(df: DataFrame) -> int:
    """Buckets for work that follows the input's size: the session's shuffle
    partitions, or more when the files are larger than these would hold."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(least, min(-(-size // BUCKET_BYTES), 1 << 20))


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column as one uint8 array, and the n + 1 offsets into it."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_binary())
    offsets = np.frombuffer(col.buffers()[1], np.int64, len(col) + 1, col.offset * 8)
    body = col.buffers()[2]
    if body is None or len(col) == 0 or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    data = np.frombuffer(body, np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def doc_slices(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The batches cut at row borders into slices of about ``most`` text bytes
    (a longer row is a slice of its own), so that work space stays bounded."""
    for batch in batches:
        _, offsets = text_buffer(batch.column("text"))
        lo = 0
        while lo < batch.num_rows:
            hi = int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1
            hi = min(max(hi, lo + 1), batch.num_rows)
            yield batch.slice(lo, hi - lo)
            lo = hi


def longs(col: pa.Array) -> np.ndarray:
    """A long column without nulls as numpy (no copy where Arrow allows it)."""
    return col.to_numpy(zero_copy_only=False)

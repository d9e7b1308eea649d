"""Session and shared-storage helpers."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session should carry.  Time is always handled in UTC inside the
# session; local zones are explicit arguments of the functions that need them.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    # remove reliable-checkpoint files (ingest deltas) once they are unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tidemark", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the base settings.

    On a cluster leave ``master`` unset; the launcher provides it.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_work_roots: set[str] = set()


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins.  Only a local session (tests) without
    the setting gets a folder of its own; a cluster session without it is an
    error, because a machine-local folder is not visible to other executors.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not _is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        # spark.checkpoint.dir cannot be changed at run time; the context's
        # checkpoint folder can, and later calls read it back from there
        d = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder for staged tables.

    An application's folders are removed when its Python process ends while the
    session is up; results read from them are lazy, so not before.
    """
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tidemark/{spark.sparkContext.applicationId}"
    if base not in _work_roots:
        _work_roots.add(base)
        atexit.register(_remove_work, spark, base)
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def _remove_work(spark: SparkSession, base: str) -> None:
    if spark.sparkContext._jsc is not None:
        delete_path(spark, base)


def hadoop_fs(spark: SparkSession, path: str):
    """Hadoop FileSystem and Path objects for ``path`` (delete / rename)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_fs(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_fs(spark, path)
    return bool(fs.delete(p, True))


def rename_path(spark: SparkSession, path: str, to: str) -> None:
    """Rename a file or folder; an error if the file system refuses."""
    fs, p = hadoop_fs(spark, path)
    if not fs.rename(p, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"cannot rename {path} to {to}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there as a whole or not at all."""
    fs, p = hadoop_fs(spark, f"{path}.tmp")
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()
    rename_path(spark, f"{path}.tmp", path)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = hadoop_fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def list_names(spark: SparkSession, folder: str) -> list[tuple[str, bool]]:
    """(name, is a folder) of what is right below ``folder``."""
    fs, p = hadoop_fs(spark, folder)
    return [(x.getPath().getName(), x.isDirectory()) for x in fs.listStatus(p)] if fs.exists(p) else []


def data_files(spark: SparkSession, folder: str, below: str = "") -> list[str]:
    """Data files below ``folder`` as relative names."""
    out = []
    for name, is_folder in list_names(spark, f"{folder}/{below}"):
        if name.startswith(("_", ".")):
            continue
        out += data_files(spark, folder, f"{below}{name}/") if is_folder else [below + name]
    return out


__all__ = ["rename_path", "write_text", "read_text", "list_names", "data_files", "get_session", "ensure_checkpoint_dir", "work_dir", "path_exists",
           "delete_path"]

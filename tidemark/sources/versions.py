"""Tables that change in one step: a version names the files that the table consists of.

Files are written once and never moved or overwritten.  A change writes its files into
a folder of its own and then publishes ``_versions/<number>``, one small file that is
there as a whole or not at all and lists the files by *cell* (a period, a range of a
state table; cells that did not change keep their files).  Readers take the highest
number, so a reader sees the rows of one version; files of the last ``KEEP`` versions
stay for readers that began with these.  Of two writers that start from the same
version the later one fails and may start again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidemark.session import data_files, delete_path, hadoop_fs, list_names, path_exists, read_text, rename_path

#: Versions whose files stay; characters that a version's number is written with.
KEEP, DIGITS = 3, 12
Cells = dict[str, list[str]]


class Version(NamedTuple):
    number: int
    cells: Cells
    run: str | None  # name of the change that made it
    schema: str | None = None  # as JSON, if the writer has told it
    fmt: str = "parquet"

    def files(self, cells: Iterable[str] | None = None) -> list[str]:
        return [f for c in (self.cells if cells is None else cells) for f in self.cells.get(c, ())]


class Changed(RuntimeError):
    """Another writer has published the next version."""


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n) for n, _ in list_names(spark, f"{path}/_versions") if n.isdigit())


def _load(spark: SparkSession, path: str, number: int) -> Version:
    text = json.loads(read_text(spark, f"{path}/_versions/{number:0{DIGITS}d}"))
    return Version(number, text["cells"], text.get("run"), text.get("schema"), text.get("fmt", "parquet"))


def current(spark: SparkSession, path: str) -> Version:
    """The version that a reader takes now (number 0 and no files: none yet)."""
    numbers = _numbers(spark, path.rstrip("/"))
    return _load(spark, path.rstrip("/"), numbers[-1]) if numbers else Version(0, {}, None)


def write_cells(df: DataFrame, path: str, cell: str) -> Cells:
    """Write the rows as new files below ``path``, by the text column ``cell``; no version holds them yet."""
    spark, folder = df.sparkSession, f"data/{uuid.uuid4().hex}"
    df.hint("rebalance", cell).write.partitionBy(cell).parquet(f"{path.rstrip('/')}/{folder}")
    out: Cells = {}
    unquote = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    for f in data_files(spark, f"{path.rstrip('/')}/{folder}"):
        out.setdefault(unquote(f.split("/")[0].split("=", 1)[1]), []).append(f"{folder}/{f}")
    return out


def write_files(df: DataFrame, path: str, fmt: str = "parquet") -> list[str]:
    """Write the rows as new files below ``path``; no version holds them yet."""
    folder = f"data/{uuid.uuid4().hex}"
    df.write.format(fmt).save(f"{path.rstrip('/')}/{folder}")
    return [f"{folder}/{f}" for f in data_files(df.sparkSession, f"{path.rstrip('/')}/{folder}")]


def has_run(spark: SparkSession, path: str, run: str) -> bool:
    """Whether the change named ``run`` is among the last KEEP ones."""
    return any(_load(spark, path.rstrip("/"), n).run == run for n in _numbers(spark, path.rstrip("/")))


def publish(spark: SparkSession, path: str, after: Version, cells: Mapping[str, list[str]], run: str | None = None,
            schema: StructType | None = None, fmt: str = "parquet") -> Version:
    """Make ``cells`` the table's next version after ``after``."""
    path = path.rstrip("/")
    name = f"{path}/_versions/{after.number + 1:0{DIGITS}d}"
    draft = f"{path}/_versions/_{uuid.uuid4().hex}"
    fs, p = hadoop_fs(spark, draft)
    out = fs.create(p, True)
    text = {"cells": {c: f for c, f in cells.items() if f}, "run": run, "fmt": fmt,
            "schema": schema.json() if schema is not None else after.schema}
    out.write(bytearray(json.dumps(text).encode()))
    out.close()
    if path_exists(spark, name):
        delete_path(spark, draft)
        raise Changed(f"{path} has changed since version {after.number}")
    rename_path(spark, draft, name)
    _clean(spark, path)
    return current(spark, path)


def _clean(spark: SparkSession, path: str) -> None:
    """Drop versions past the last KEEP and the folders that only these name."""
    numbers = _numbers(spark, path)
    old, kept = numbers[:-KEEP], numbers[-KEEP:]
    if not old:
        return
    used = {f.split("/")[1] for n in kept for f in _load(spark, path, n).files()}
    gone = {f.split("/")[1] for n in old for f in _load(spark, path, n).files()} - used
    for n in old:
        delete_path(spark, f"{path}/_versions/{n:0{DIGITS}d}")
    for folder in gone:
        delete_path(spark, f"{path}/data/{folder}")


def read_version(spark: SparkSession, path: str, schema: StructType | str | None = None,
                 cells: Iterable[str] | None = None, version: Version | None = None) -> DataFrame:
    """Rows of the table's current version (or of the one given), of all or of some cells,
    in the schema given or the version's own."""
    version = version or current(spark, path)
    if schema is None:
        if version.schema is None:
            raise ValueError(f"{path} has no version that tells its schema")
        schema = StructType.fromJson(json.loads(version.schema))
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    files = version.files(cells)
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).format(version.fmt).load([f"{path.rstrip('/')}/{f}" for f in files])


__all__ = ["Version", "Changed", "current", "has_run", "publish", "write_cells", "write_files", "read_version"]

"""Table reads, CSV export / load, and full-refresh table copies."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import delete_path, work_dir
from tidemark.sources.versions import current, publish, read_version, write_files


def read_table(spark: SparkSession, source: str, columns: Sequence[str] | None = None,
               fmt: str = "parquet", options: Mapping[str, str] | None = None) -> DataFrame:
    """``SELECT {columns or *} FROM source``.

    ``source`` is a path (``fmt`` parquet / orc / csv / json, or ``versioned`` for a table
    that ``replace_table`` or a period refresh keeps), a catalog table (``fmt="table"``), free SQL over the session's tables (``fmt="sql"``) or a
    JDBC table or query (``fmt="jdbc"``, see ``jdbc_options``).  Column selection
    happens before any action, so only those columns are read.
    """
    opts = dict(options or {})
    if fmt == "versioned":
        df = read_version(spark, source)
    elif fmt == "table":
        df = spark.read.options(**opts).table(source)
    elif fmt == "sql":
        df = spark.sql(source)
    elif fmt == "jdbc":
        df = spark.read.format("jdbc").options(**jdbc_options(source, opts)).load()
    else:
        df = spark.read.format(fmt).options(**opts).load(source)
    return df.select(*columns) if columns else df


_PARALLEL = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")


def jdbc_options(source: str, options: Mapping[str, str]) -> dict[str, str]:
    """Reader options for a JDBC table name or a ``SELECT``.

    A read without a split is one connection and one task, so the four options
    of a parallel read (``partitionColumn``, ``lowerBound``, ``upperBound``,
    ``numPartitions``) are required; ``numPartitions="1"`` alone asks for a single
    connection.  A query is passed as a derived table, because the ``query``
    option excludes a split.
    """
    opts = {k: str(v) for k, v in options.items()}
    missing = [k for k in _PARALLEL if k not in opts]
    if missing and opts.get("numPartitions") != "1":
        raise ValueError(f"parallel JDBC read needs {', '.join(missing)} (or numPartitions=1)")
    words = source.split(None, 1)
    is_query = bool(words) and words[0].lower() in ("select", "with")
    return {"dbtable": f"({source}) q" if is_query else source, **opts}


def _sql_literal(value) -> str:
    if isinstance(value, (_dt.date, _dt.datetime)):
        kind = "TIMESTAMP" if isinstance(value, _dt.datetime) else "DATE"
        return f"{kind} '{value.isoformat(sep=' ') if kind == 'TIMESTAMP' else value.isoformat()}'"
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)


def split_predicates(column: str, points: Sequence) -> list[str]:
    """Disjoint conditions that every row meets one of: below the first split point, from one
    to below the next, from the last on, and NULL."""
    p = [_sql_literal(x) for x in sorted(set(points))]
    if not p:
        return [f"{column} IS NOT NULL", f"{column} IS NULL"]
    between = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(p, p[1:])]
    return [f"{column} < {p[0]}", *between, f"{column} >= {p[-1]}", f"{column} IS NULL"]


def split_points(keys: DataFrame, column: str, splits: int) -> list:
    """Points that cut the rows of ``keys`` into about ``splits`` equal parts.

    ``keys`` has the key's distribution: the table's own key column, an earlier copy or
    the database's histogram as rows.  A value that holds more than a part of the rows is
    a part of its own: it is a point, and so is the next larger value.  The points come to
    the driver, at most two for each part.
    """
    if splits < 2:
        return []
    per = keys.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("k")).agg(F.count("*").alias("n"))
    total = per.agg(F.sum("n")).first()[0] or 0
    hot = per.where(F.col("n") * splits > total).select("k")  # fewer than ``splits``
    after = hot.alias("h").join(per.alias("p"), F.col("p.k") > F.col("h.k")).groupBy("h.k").agg(F.min("p.k").alias("k2"))
    own = [r[0] for r in hot.collect()] + [r["k2"] for r in after.collect()]
    # the quantiles of the others, by range-sorted running counts
    rest = per.join(hot, "k", "left_anti")
    parts = rest.sort("k").withColumn("_task", F.spark_partition_id()).withColumn("_row", F.monotonically_increasing_id()).persist()
    try:
        tasks = parts.groupBy("_task").agg(F.sum("n").alias("_n"))
        before = F.coalesce(F.sum("_n").over(Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        starts = tasks.select("_task", before.alias("_before"))
        within = F.sum("n").over(Window.partitionBy("_task").orderBy("_row"))
        end = F.col("_before") + within
        step = F.lit(max(total / splits, 1.0))
        cut = F.floor(end / step) > F.floor((end - F.col("n")) / step)
        points = [r["k"] for r in parts.join(starts, "_task").withColumn("_cut", cut).where("_cut").select("k").collect()]
    finally:
        parts.unpersist()
    return sorted(set(own) | set(points))


def read_jdbc_split(spark: SparkSession, url: str, source: str, column: str, points: Sequence,
                    properties: Mapping[str, str] | None = None) -> DataFrame:
    """JDBC read with one connection for each part of ``split_predicates``."""
    return spark.read.jdbc(url, jdbc_options(source, {"numPartitions": 1})["dbtable"],
                           predicates=split_predicates(column, points), properties=dict(properties or {}))


def stream_table(spark: SparkSession, path: str, schema, fmt: str = "parquet",
                 max_files_per_trigger: int | None = 1000) -> DataFrame:
    """A table path as a file stream (Structured Streaming file source).

    A directory of part files is streamed as it is; a single file is streamed
    from its folder with a name filter.  ``max_files_per_trigger`` bounds each
    micro-batch (the file analogue of Kafka's ``maxOffsetsPerTrigger``).
    """
    from tidemark.session import hadoop_fs

    fs, p = hadoop_fs(spark, path)
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    if fs.exists(p) and fs.getFileStatus(p).isFile():
        return r.option("pathGlobFilter", p.getName()).load(p.getParent().toString())
    return r.load(path)


# One form of CSV for both directions: quotes are doubled, blanks stay, empty text
# is "" and NULL is nothing between the separators.
_CSV = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False, "emptyValue": '""', "nullValue": "", "lineSep": "\n"}
#: What a quoted empty value is read as before it becomes empty text (the reader
#: would take empty text for NULL).
_EMPTY = "\x01empty text\x01"


def export_csv(df: DataFrame, path: str, single_file: bool = False, mode: str = "overwrite") -> str:
    """Header CSV without index column.

    ``single_file`` funnels the rows through one task and is meant for small
    extracts (such as a count); large tables are written in parallel.  Values
    with line breaks are quoted; a file is read whole by one task then, so the
    number of files bounds the work of a load.
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).options(**_CSV, quoteAll=False, escapeQuotes=True).csv(path)
    return path


def load_csv(spark: SparkSession, path: str, infer_schema: bool = True, schema=None) -> DataFrame:
    """Read header CSV as ``export_csv`` writes it, values unchanged.

    Types are inferred from all rows (``autodetect``) unless ``schema`` is given;
    inference reads the data once more before the load.  With a schema, a value
    that does not fit it is an error, not a NULL.
    """
    r = spark.read.options(**_CSV | {"emptyValue": _EMPTY}, multiLine=True, mode="FAILFAST")
    df = r.schema(schema).csv(path) if schema is not None else r.option("inferSchema", infer_schema).csv(path)
    return df.select(*[F.when(F.col(f"`{c}`") == _EMPTY, F.lit("")).otherwise(F.col(f"`{c}`")).alias(c)
                       if t == "string" else F.col(f"`{c}`") for c, t in df.dtypes])


def replace_table(df: DataFrame, target_path: str, fmt: str = "parquet") -> DataFrame:
    """Replace the table at ``target_path`` by the rows of ``df``.

    The table is kept in versions: the rows are written as new files, then one small file
    names them as the table.  ``read_table(spark, path, fmt="versioned")`` reads the current
    version; a reader sees the old rows or the new ones, a failed write changes nothing,
    and ``df`` may read the target itself.
    """
    spark, base = df.sparkSession, target_path.rstrip("/")
    old = current(spark, base)
    publish(spark, base, old, {"all": write_files(df, base, fmt)}, schema=df.schema, fmt=fmt)
    return read_version(spark, base)


def load_csv_replace(spark: SparkSession, csv_path: str, target_path: str,
                     fmt: str = "parquet", schema=None) -> DataFrame:
    """Load staged CSV and replace the target (``WRITE_TRUNCATE``)."""
    return replace_table(load_csv(spark, csv_path, schema=schema), target_path, fmt)


def copy_table(spark: SparkSession, source: DataFrame, target_path: str,
               columns: Sequence[str] | None = None, via_csv: bool = False,
               fmt: str = "parquet") -> DataFrame:
    """Full-refresh copy: read, select, replace the target (``replace_table``).

    ``via_csv`` reproduces the staged hop (table -> CSV stage -> load with
    inferred types -> delete stage); the stage lives below the shared
    checkpoint folder.  The direct path keeps the source types.
    """
    df = source.select(*columns) if columns else source
    if via_csv:
        stage = work_dir(spark, "csv-stage")
        export_csv(df, stage)
        out = load_csv_replace(spark, stage, target_path, fmt)
        delete_path(spark, stage)
        return out
    return replace_table(df, target_path, fmt)


def copy_tables(spark: SparkSession, tables: Sequence[Mapping[str, object]],
                resolve: Callable[[str, str], DataFrame], target: Callable[[str, str], str],
                via_csv: bool = False) -> dict[str, DataFrame]:
    """Copy a list of ``{"schema", "tabellnavn"|"table", "columns"?}`` entries.

    ``resolve(schema, table)`` gives the source DataFrame, ``target(schema,
    table)`` the destination path.  One Spark job per table.
    """
    out: dict[str, DataFrame] = {}
    for t in tables:
        schema = str(t.get("schema", ""))
        name = str(t.get("tabellnavn", t.get("table", "")))
        cols = list(t.get("columns", []) or [])  # type: ignore[arg-type]
        out[f"{schema}.{name}" if schema else name] = copy_table(
            spark, resolve(schema, name), target(schema, name), cols or None, via_csv)
    return out


__all__ = ["read_table", "jdbc_options", "split_predicates", "split_points", "read_jdbc_split", "stream_table", "export_csv", "load_csv", "load_csv_replace", "copy_table", "copy_tables",
           "replace_table"]

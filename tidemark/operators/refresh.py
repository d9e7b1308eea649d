"""Period refresh: replace one period of a table, insert the source rows.

Semantics of the warehouse job: ``DELETE FROM t WHERE periode = p`` followed by
``INSERT INTO t SELECT cols FROM source`` in one transaction.  The source is
not filtered on ``p``; its rows of other periods are added to the table, and
rows with a NULL period stay.

The table is kept in versions (``sources.versions``) with a cell for each period.  A
refresh writes the source's rows as new files and publishes a version in which the
period's cell holds these alone and other periods' cells have theirs added; no file
of another period is read or written.  Readers see the old version or the new one.
A refresh that stops before its version is published has changed nothing and is run
again; one that is named by a ``run`` is not applied twice, so rows of other periods are
not added a second time.

Dynamic partition overwrite is *not* used: it would also replace every other
period the source holds, and it would leave ``p`` untouched when the source has
no row of ``p``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import list_names
from tidemark.sources.versions import Version, current, has_run, publish, read_version, write_cells

_CELL = "cell_of_version"
#: Cell of the rows without a period; the others' begin with ``=``.
NO_PERIOD = "none"


def _cell_of(period_col: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(period_col).cast("string")), F.lit(NO_PERIOD))


def _new_cells(df: DataFrame, path: str, period_col: str) -> dict[str, list[str]]:
    return write_cells(df.withColumn(_CELL, _cell_of(period_col)), path, _CELL)


def _version(spark: SparkSession, path: str) -> Version:
    version = current(spark, path)
    if not version.number and any(not n.startswith(("_", ".")) and n != "data" for n, _ in list_names(spark, path)):
        raise ValueError(f"{path} is not kept in versions; write it with write_periodic first")
    return version


def write_periodic(df: DataFrame, path: str, period_col: str, mode: str = "overwrite") -> None:
    """Write a table by its period column, replacing the rows there or adding to them.

    Rows of a period come together in few files; a period that is larger than the
    advisory partition size is split over several tasks.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode {mode!r}")
    spark, path = df.sparkSession, path.rstrip("/")
    version = _version(spark, path)
    cells = _new_cells(df, path, period_col)
    if mode == "append":
        cells = {c: [*version.cells.get(c, ()), *cells.get(c, ())] for c in {*version.cells, *cells}}
    publish(spark, path, version, cells, schema=df.schema)


def read_periodic(spark: SparkSession, path: str, schema=None, columns: Sequence[str] | None = None,
                  periods: Sequence[str | None] | None = None) -> DataFrame:
    """The table's current rows, of all periods or of those named (None: without a period);
    only these periods' files are read."""
    cells = None if periods is None else [NO_PERIOD if p is None else f"={p}" for p in periods]
    rows = read_version(spark, path, schema, cells)
    return rows.select(*columns) if columns else rows


def period_refresh(spark: SparkSession, target_path: str, source: DataFrame, period_col: str,
                   period: str, columns: Sequence[str] | None = None,
                   strict: bool = False, run: str | None = None) -> DataFrame:
    """Replace period ``period`` of the table at ``target_path`` with ``source`` rows.

    ``strict`` rejects a source with rows of other periods.  ``run`` names the refresh: a
    repeated run (after a stop) is applied once; without a name every call is applied.
    """
    cols = list(columns) if columns else source.columns
    src = source.select(*cols)
    if strict:
        bad = src.agg(F.count_if(~F.col(period_col).eqNullSafe(F.lit(period))).alias("n")).first()
        if bad and bad["n"]:
            raise ValueError(f"source holds {bad['n']} rows outside period {period}")
    target = target_path.rstrip("/")
    if run is None or not has_run(spark, target, run):
        old = _version(spark, target)
        new = _new_cells(src, target, period_col)
        cells = {c: [*old.cells.get(c, ()), *new.get(c, ())] for c in {*old.cells, *new}}
        cells[f"={period}"] = new.get(f"={period}", [])
        publish(spark, target, old, cells, run, src.schema)
    return read_periodic(spark, target, src.schema, cols)


__all__ = ["period_refresh", "write_periodic", "read_periodic"]

"""Join-based quality checks: validity intervals, unmatched rows, new domain values.

None of these hints a broadcast.  Dimension and mapping sides are often small,
but their size is data-dependent; Catalyst broadcasts them when the plan-time
estimate is under ``spark.sql.autoBroadcastJoinThreshold`` and AQE switches to
a broadcast at run time when the shuffled side turns out small.  Otherwise
they run as shuffle joins, and AQE splits skewed keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALT = "_salt"
#: Joins that return no row of the copied side on its own.
SALTED_JOINS = {"inner", "left", "leftouter", "leftsemi", "semi", "leftanti", "anti"}


def _salted(facts: DataFrame, other: DataFrame, salt: int) -> tuple[DataFrame, DataFrame]:
    """Split hot keys over ``salt`` tasks.

    Each fact row gets a salt from its position (so even identical copies of a
    row spread), the other side is copied once per salt value (a fixed
    factor).  The salt only chooses the task: every salt value meets a full
    copy of the other side, so the result does not depend on it, and Spark
    reruns the dependent stage as a whole if a salted map stage is retried.
    """
    f = facts.withColumn(SALT, F.pmod(F.monotonically_increasing_id(), F.lit(salt)))
    o = other.withColumn(SALT, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salt - 1).cast("long"))))
    return f, o


def validity_join(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, fact_day: str,
                  valid_from: str, valid_to: str, how: str = "inner", salt: int = 1) -> DataFrame:
    """Rows of ``facts`` joined with every ``dim`` row whose interval holds the day.

    Equi join on the key with ``day BETWEEN valid_from AND valid_to`` (both ends
    inclusive) as residual condition, so it plans as a hash / sort-merge join on
    the key, never a nested loop.  Overlapping intervals give one row each.

    ``salt > 1`` spreads each key over ``salt`` tasks (for a key holding a large
    share of the facts when AQE's skew split is not available); the dimension
    is copied ``salt`` times.  When only the number of join rows is needed,
    ``validity_join_count`` pre-aggregates instead.
    """
    if salt > 1:
        if how.replace("_", "").lower() not in SALTED_JOINS:
            raise ValueError(f"salt copies the dimension, which a {how!r} join would return again; use salt=1")
        facts, dim = _salted(facts, dim, salt)
    f = facts.alias("_f")
    d = dim.alias("_d")
    cond = (F.col(f"_f.{fact_key}") == F.col(f"_d.{dim_key}")) & \
        F.col(f"_f.{fact_day}").between(F.col(f"_d.{valid_from}"), F.col(f"_d.{valid_to}"))
    if salt > 1:
        cond = cond & (F.col(f"_f.{SALT}") == F.col(f"_d.{SALT}"))
        out = f.join(d, cond, how)
        if "semi" in how or "anti" in how:
            return out.drop(SALT)
        return out.drop(F.col(f"_f.{SALT}")).drop(F.col(f"_d.{SALT}"))
    return f.join(d, cond, how)


#: Bins of the finest level are this many days wide; each level's are SPAN times the last one's.
BIN_DAYS, SPAN, LEVELS = 7, 16, 6
#: Level of the intervals that have a row for each of their days; a fact of the day meets no other.
DAILY = -1


def _bin(day: Column, level: Column | int, bin_days: int) -> Column:
    level = level if isinstance(level, Column) else F.lit(level)
    width = F.when(level == DAILY, F.lit(1)).otherwise(F.lit(int(bin_days)) * F.pow(F.lit(SPAN), level).cast("long"))
    return F.floor(F.unix_date(day.cast("date")) / width)


def binned(facts: DataFrame, dim: DataFrame, fact_day: str, valid_from: str, valid_to: str,
           bin_days: int = BIN_DAYS) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``_level`` and ``_bin``: an interval has a row for each bin that it
    touches, at the finest level where these are SPAN + 1 at most; one no longer than a bin
    has a row for each of its days instead, if these are as few.  A fact has a row for each
    level that intervals use (found by one aggregate inside the plan)."""
    days = [F.unix_date(F.col(c).cast("date")) for c in (valid_from, valid_to)]
    level = F.lit(LEVELS - 1)
    for k in reversed(range(LEVELS - 1)):
        level = F.when(_bin(F.col(valid_to), k, bin_days) - _bin(F.col(valid_from), k, bin_days) <= SPAN, F.lit(k)).otherwise(level)
    level = F.when(days[1] - days[0] < min(int(bin_days), SPAN + 1), F.lit(DAILY)).otherwise(level)
    d = dim.where(days[0] <= days[1]).withColumn("_level", level)
    used = d.agg(F.sort_array(F.collect_set("_level")).alias("levels")).scalar()
    d = d.withColumn("_bin", F.explode(F.sequence(_bin(F.col(valid_from), F.col("_level"), bin_days),
                                                  _bin(F.col(valid_to), F.col("_level"), bin_days))))
    f = facts.where(F.col(fact_day).isNotNull()).withColumn("_level", F.explode(used))
    return f.withColumn("_bin", _bin(F.col(fact_day), F.col("_level"), bin_days)), d


def validity_join_binned(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, fact_day: str,
                         valid_from: str, valid_to: str, bin_days: int = BIN_DAYS, salt: int = 1) -> DataFrame:
    """``validity_join`` (inner) for keys with many intervals.

    The equi join of ``validity_join`` compares every fact of a key with every interval of
    it.  Here intervals are cut at bins of days and the sides meet on key and bin, with
    the exact bounds as residual: a fact meets the intervals around its day, so the
    work follows facts, intervals and matches, and a key with many facts is spread
    over its bins.  Short intervals are met on their days alone.  Long and open-ended intervals go to coarser bins (``binned``), so none
    is copied more than SPAN + 1 times.  A fact meets an interval in one bin only, so no
    row comes twice.  Intervals with a NULL or reversed bound match nothing.  ``salt``
    spreads a bin's facts further, as in ``validity_join``.
    """
    f, d = binned(facts, dim, fact_day, valid_from, valid_to, bin_days)
    on = ["_level", "_bin"]
    if salt > 1:
        f, d = _salted(f, d, salt)
        on.append(SALT)
    f, d = f.alias("_f"), d.alias("_d")
    cond = (F.col(f"_f.{fact_key}") == F.col(f"_d.{dim_key}")) & \
        F.col(f"_f.{fact_day}").between(F.col(f"_d.{valid_from}"), F.col(f"_d.{valid_to}"))
    for c in on:
        cond = cond & (F.col(f"_f.{c}") == F.col(f"_d.{c}"))
    out = f.join(d, cond)
    for c in on:
        out = out.drop(F.col(f"_f.{c}")).drop(F.col(f"_d.{c}"))
    return out


def validity_join_count(facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                        fact_day: str, valid_from: str, valid_to: str,
                        name: str = "n_rows") -> DataFrame:
    """Number of join rows of ``validity_join`` without materialising them.

    Facts are first collapsed to (key, day, n) with a map-side partial
    aggregate, so a key holding a third of all facts costs at most one row per
    day and map task; the join then runs on those rows and sums ``n``.
    """
    per_day = facts.groupBy(F.col(fact_key).alias(fact_key), F.col(fact_day).alias(fact_day)) \
        .agg(F.count(F.lit(1)).alias("_n"))
    j = validity_join(per_day, dim, fact_key, dim_key, fact_day, valid_from, valid_to)
    return j.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias(name))


def unmatched_count(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                    name: str = "n_unmatched") -> DataFrame:
    """Number of ``left`` rows with no equal key in ``right``, pre-aggregated by key."""
    per_key = left.groupBy(F.col(left_key).alias(left_key)).agg(F.count(F.lit(1)).alias("_n"))
    return (unmatched(per_key, right, left_key, right_key)
            .agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias(name)))


def unmatched(left: DataFrame, right: DataFrame, left_key: str | Column, right_key: str,
              salt: int = 1) -> DataFrame:
    """Rows of ``left`` with no equal key in ``right`` (``LEFT JOIN ... IS NULL``).

    A left anti join: the same count, no duplication when the right side repeats
    a key, and rows with a NULL left key are kept (they match nothing).
    ``salt > 1`` spreads a hot left key over ``salt`` tasks; the distinct right
    keys are copied ``salt`` times.
    """
    lk = F.col(left_key) if isinstance(left_key, str) else left_key
    r = right.select(F.col(right_key).alias("_rk")).where(F.col("_rk").isNotNull()).distinct()
    if salt > 1:
        cols = left.columns
        left_s, r_s = _salted(left, r, salt)
        cond = (lk == F.col("_rk")) & (left_s[SALT] == r_s[SALT])
        return left_s.join(r_s, cond, "left_anti").select(*cols)
    return left.join(r, lk == F.col("_rk"), "left_anti")


def new_values(values: DataFrame, col: str, domain: DataFrame, domain_col: str,
               name: str | None = None) -> DataFrame:
    """Distinct values of ``col`` absent from the distinct ``domain_col`` values.

    NULL is reported as a new value (it matches nothing).
    """
    out = name or col
    v = values.select(F.col(col).alias(out)).distinct()
    d = domain.select(F.col(domain_col).alias("_dv")).where(F.col("_dv").isNotNull()).distinct()
    return v.join(d, F.col(out) == F.col("_dv"), "left_anti")


def not_in_values(values: DataFrame, col: str, domain: DataFrame, domain_col: str,
                  name: str | None = None, distinct: bool = True) -> DataFrame:
    """``SELECT [DISTINCT] col FROM values WHERE col NOT IN (SELECT domain_col FROM domain)``.

    SQL three-valued logic: one NULL in the domain makes every comparison
    unknown, so nothing is returned; a NULL value is never returned unless the
    domain is empty.  Spark plans SQL ``NOT IN`` as a null-aware anti join only
    when the domain can be broadcast and falls back to a nested-loop join
    otherwise.  This form is a hash anti join on the non-null domain plus two
    scalar subquery (domain row count and NULL count, one row), so it scales
    with both sides.
    """
    out = name or col
    v = values.select(F.col(col).alias(out))
    if distinct:
        v = v.distinct()
    dom = domain.select(F.col(domain_col).alias("_dv"))
    # one scalar subquery, one scan of the domain: (rows, NULL rows)
    stats = dom.select(F.struct(F.count(F.lit(1)).alias("n"),
                                F.count_if(F.col("_dv").isNull()).alias("n_null"))).scalar()
    n_all, n_null = stats["n"], stats["n_null"]
    non_null = dom.where(F.col("_dv").isNotNull()).distinct()
    anti = v.join(non_null, F.col(out) == F.col("_dv"), "left_anti")
    return anti.where((n_all == 0) | (F.col(out).isNotNull() & (n_null == 0)))


__all__ = ["validity_join", "validity_join_binned", "validity_join_count", "unmatched", "unmatched_count", "new_values",
           "not_in_values"]

"""Data checks. Each returns a DataFrame of violations (empty = pass) or raises.

Checks are aggregates or anti-joins, so they run distributed; only the final
violation counts ever reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from strata.functions.constants import RECENT_PARTITIONS_N
from strata.sinks.swap import path_exists


class CheckFailed(AssertionError):
    pass


# --- raw lake and outputs --------------------------------------------------


def recent_partitions(raw: DataFrame, n: int = RECENT_PARTITIONS_N) -> DataFrame:
    """The n newest ``event_date`` values present (distinct, newest first)."""
    return raw.select("event_date").distinct().orderBy(F.col("event_date").desc()).limit(n)


def check_raw_partitions(raw: DataFrame, n: int = RECENT_PARTITIONS_N) -> DataFrame:
    """Fail when the raw lake holds no rows; else return its newest partitions."""
    if raw.select("event_date").limit(1).count() == 0:
        raise CheckFailed("the raw lake is empty")
    return recent_partitions(raw, n)


def check_outputs(
    spark: SparkSession,
    outputs: dict[str, str],
    fmt: str = "parquet",
    min_rows: dict[str, int] | None = None,
    columns: dict[str, Iterable[str]] | None = None,
) -> DataFrame:
    """Row count and column list per output; fail with every output that falls short.

    ``outputs`` maps an output name to its path. Optionally each must have a
    least number of rows and exactly the given columns. Only an absent path
    counts as absent: an unreadable one raises its own error. The loop is over
    the fixed list of outputs (one count job each), not over data.
    """
    rows, faults = [], []
    for name, path in outputs.items():
        if not path_exists(spark, path):
            faults.append(f"{name}: nothing stored at {path}")
            continue
        df = spark.read.format(fmt).load(path)
        n, least = df.count(), (min_rows or {}).get(name, 0)
        if n < least:
            faults.append(f"{name}: {n} rows instead of {least} or more")
        wanted = list((columns or {}).get(name, df.columns))
        if sorted(wanted) != sorted(df.columns):
            faults.append(f"{name}: columns {df.columns} instead of {wanted}")
        rows.append((name, n, ",".join(df.columns)))
    if faults:
        raise CheckFailed("; ".join(faults))
    # A literal relation built in the JVM (no Python worker, no RDD of rows).
    return spark.range(1).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("output"),
                        F.lit(count).cast("bigint").alias("row_count"),
                        F.lit(columns).alias("columns"),
                    )
                    for name, count, columns in rows
                ]
            )
        )
    )


def check_row_count(df: DataFrame, min_rows: int, name: str = "table") -> int:
    """Fail when ``df`` has fewer than ``min_rows`` rows; return the count."""
    n = df.count()
    if n < min_rows:
        raise CheckFailed(f"{name}: {n} rows, expected at least {min_rows}")
    return n


# --- column tests ----------------------------------------------------------


def unique_violations(df: DataFrame, keys: str | Iterable[str]) -> DataFrame:
    """Key values that occur more than once, with their count (``n``)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def null_counts(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """One row per column: (column, null_count) over the whole table, one pass."""
    cols = list(cols)
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', `{c}`" for c in cols)
    return counts.selectExpr(f"stack({len(cols)}, {stack}) as (column, null_count)")


def not_null_violations(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Rows where any of ``cols`` is null."""
    cond = None
    for c in cols:
        cond = F.col(c).isNull() if cond is None else cond | F.col(c).isNull()
    return df.filter(cond)


def accepted_values_violations(df: DataFrame, col: str, values: Iterable) -> DataFrame:
    """Rows whose ``col`` is not one of ``values`` (nulls are not violations)."""
    return df.filter(~F.col(col).isin(list(values)))


def relationship_violations(
    child: DataFrame, parent: DataFrame, child_key: str, parent_key: str
) -> DataFrame:
    """Child key values without a parent row, with the number of child rows.

    Written as aggregate-then-anti-join; Catalyst pushes the anti join below
    the aggregate (its condition uses only the grouping key), so when the
    parent keys fit the broadcast threshold the child rows stream through a
    hash anti join without any shuffle and only violating keys reach the
    aggregate's exchange. Beyond the threshold it is a sort-merge anti join
    whose hot-key partitions adaptive execution splits.
    """
    keys = child.filter(F.col(child_key).isNotNull()).groupBy(child_key).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    parents = parent.select(F.col(parent_key).alias("_pk"))
    return keys.join(parents, keys[child_key] == parents["_pk"], "left_anti")


def scale_violations(df: DataFrame, col: str, scale: int = 2) -> DataFrame:
    """Rows whose ``col`` has more decimal places than ``scale`` (money() would round them)."""
    return df.filter(F.col(col) != F.round(F.col(col), scale))


def negative_violations(df: DataFrame, col: str) -> DataFrame:
    """Rows with a negative value in ``col``."""
    return df.filter(F.col(col) < 0)


def future_violations(df: DataFrame, col: str, now: Column | None = None) -> DataFrame:
    """Rows whose time ``col`` lies after ``now`` (default: the query's current time)."""
    now = now if now is not None else F.current_timestamp()
    return df.filter(F.col(col).cast("timestamp") > now)


# --- trend alert ------------------------------------------------------------


def day_over_day_change(daily: DataFrame, date_col: str, value_col: str) -> DataFrame:
    """Adds ``prev_value`` and ``change`` (relative, null on a zero base).

    The input must be one row per day: the ordered window over all days runs in
    one task.
    """
    w = Window.orderBy(date_col)
    prev = F.lag(value_col).over(w)
    return daily.withColumn("prev_value", prev).withColumn(
        "change", F.try_divide(F.col(value_col) - F.col("prev_value"), F.col("prev_value"))
    )


def drop_alerts(daily: DataFrame, date_col: str, value_col: str, threshold: float = 0.3) -> DataFrame:
    """Days whose value fell by more than ``threshold`` against the day before."""
    return day_over_day_change(daily, date_col, value_col).filter(F.col("change") < -threshold)


# --- bad-record tracking ----------------------------------------------------


def quarantine(
    df: DataFrame, bad: Column, observation: Observation | None = None
) -> tuple[DataFrame, DataFrame]:
    """Split rows into (good, bad) by a condition; a null condition counts as good.

    With an ``Observation`` the good/bad counts are collected in the same pass
    that writes the good rows.
    """
    flag = F.coalesce(bad, F.lit(False))
    if observation is not None:
        df = df.observe(
            observation,
            F.count_if(flag).alias("bad_rows"),
            F.count_if(~flag).alias("good_rows"),
        )
    return df.filter(~flag), df.filter(flag)

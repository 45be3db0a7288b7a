"""Mergeable states: partial aggregates per day that are stored once and merged ever after.

A state row holds count, exact decimal sum and sum of squares, least and largest
value of a group, and optionally a distinct-count sketch. Totals, longer periods
and thresholds are merged from states, so a new day costs that day only, and no
query over history reads the events again.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATE = ["n", "n_values", "total", "squares", "least", "largest"]
#: log2 of a sketch's registers: standard error 1.04 / sqrt(2 ** LG_K), 1.6 %.
LG_K = 12


def value_states(rows: DataFrame, keys: Iterable[str | Column], value: str | Column, distinct: str | Column | None = None) -> DataFrame:
    """One state row per group. Values count to the cent; null values count in ``n`` only.

    ``distinct``: also a sketch of this column's values.
    """
    v = (F.col(value) if isinstance(value, str) else value).cast("decimal(18,2)")
    keys = [F.col(k) if isinstance(k, str) else k for k in keys]
    rows = rows.select(*keys, v.alias("_v"), *([] if distinct is None else [(F.col(distinct) if isinstance(distinct, str) else distinct).alias("_d")]))
    names = [c for c in rows.columns if c not in ("_v", "_d")]
    aggs = [
        F.count(F.lit(1)).alias("n"),
        F.count("_v").alias("n_values"),
        F.sum("_v").alias("total"),
        F.sum((F.col("_v") * F.col("_v")).cast("decimal(38,4)")).alias("squares"),
        F.min("_v").alias("least"),
        F.max("_v").alias("largest"),
    ]
    if distinct is not None:
        aggs.append(F.hll_sketch_agg("_d", LG_K).alias("sketch"))
    return rows.groupBy(*names).agg(*aggs)


def merge_states(states: DataFrame, keys: Iterable[str | Column]) -> DataFrame:
    """States of coarser groups."""
    keys = [F.col(k) if isinstance(k, str) else k for k in keys]
    aggs = [F.sum("n").alias("n"), F.sum("n_values").alias("n_values")]
    aggs += [F.sum(c).cast("decimal(38,4)" if c == "squares" else "decimal(38,2)").alias(c) for c in ("total", "squares")]
    aggs += [F.min("least").alias("least"), F.max("largest").alias("largest")]
    if "sketch" in states.columns:
        aggs.append(F.hll_union_agg("sketch").alias("sketch"))
    return states.groupBy(*keys).agg(*aggs)


def mean() -> Column:
    """Mean of a state's values; null without values."""
    return F.try_divide(F.col("total").cast("double"), F.col("n_values").cast("double"))


def stddev_samp() -> Column:
    """Sample standard deviation from the (exact) moments; null below two values."""
    n, total = F.col("n_values").cast("double"), F.col("total").cast("double")
    centred = F.greatest(F.col("squares").cast("double") - total * F.try_divide(total, n), F.lit(0.0))
    return F.when(F.col("n_values") > 1, F.sqrt(centred / (n - 1)))


def outlier_threshold(states: DataFrame, sigmas: float = 2.0) -> Column:
    """mean + sigmas * sample deviation over all states, as a scalar for filters."""
    all_ = merge_states(states, [])
    return all_.select((mean() + F.lit(sigmas) * stddev_samp()).alias("threshold")).scalar()


def distinct_estimate() -> Column:
    """Estimated number of distinct values in a state's sketch."""
    return F.hll_sketch_estimate("sketch")

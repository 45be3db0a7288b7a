"""A registry of surrogate keys: dense, stable, without collisions.

New natural keys get the numbers after the last one given out, in the order of a
digest of the natural key. Numbering has two levels: keys are counted per digest
prefix (a few thousand counts, from which every prefix gets its first number),
then numbered within their prefix; no window holds all keys. The registry is a
set of folders, one per load, behind a pointer (``strata.sinks.versions``): a
load adds a folder and never changes a key that was given out, and of two loads
at once one raises ``ConcurrentChange``.

A natural key of nulls only, or with some nulls, is a key like any other.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.sinks.swap import ConcurrentChange  # noqa: F401  (raised by commit)
from strata.sinks.versions import commit, latest

#: Hexadecimal digits of the digest that make a prefix: 4,096 prefixes.
PREFIX_DIGITS = 3


def natural_digest(keys: Iterable[str]) -> Column:
    """md5 of the natural key as JSON text, nulls included."""
    return F.md5(F.to_json(F.struct(*[F.col(f"`{k}`") for k in keys]), {"ignoreNullFields": "false"}))


def registered_keys(spark: SparkSession, path: str, key_col: str = "surrogate_key") -> DataFrame | None:
    """All natural keys with their numbers; None before the first load."""
    _, state = latest(spark, path)
    if not state:
        return None
    schema = StructType.fromDDL(state["schema"])
    stored = spark.read.schema(schema).parquet(*[f"{path.rstrip('/')}/{f}" for f in state["folders"]])
    return stored.withColumnRenamed("_key", key_col)


def _same(left: str, right: str, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.`{k}`").eqNullSafe(F.col(f"{right}.`{k}`")) for k in keys])


def register_keys(spark: SparkSession, path: str, rows: DataFrame, keys: str | Iterable[str]) -> int:
    """Give numbers to the natural keys of ``rows`` that have none; returns how many there are now.

    Numbers start with 1 and have no gaps.
    """
    path, keys = path.rstrip("/"), [keys] if isinstance(keys, str) else list(keys)
    base, state = latest(spark, path)
    new = rows.select(*[F.col(f"`{k}`") for k in keys]).distinct()
    if state:
        known = registered_keys(spark, path)
        new = new.alias("n").join(known.alias("k"), _same("n", "k", keys), "left_anti")
    else:
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new.schema.fields)
        state = {"schema": f"{fields}, _key bigint", "folders": [], "next": 1}
    new = new.withColumn("_digest", natural_digest(keys))
    new = new.withColumn("_prefix", F.substring("_digest", 1, PREFIX_DIGITS))
    # One row per prefix from here to the join: at most 16 ** PREFIX_DIGITS.
    counts = new.groupBy("_prefix").agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = counts.select("_prefix", (F.sum("_n").over(upto) - F.col("_n") + state["next"]).alias("_first"))
    inside = Window.partitionBy("_prefix").orderBy("_digest", *[F.col(f"`{k}`").asc_nulls_first() for k in keys])
    numbered = new.withColumn("_at", F.row_number().over(inside)).join(first, "_prefix")
    folder = f"load={base + 1}"
    out = numbered.select(*[F.col(f"`{k}`") for k in keys], (F.col("_first") + F.col("_at") - 1).cast("bigint").alias("_key"))
    out.write.mode("overwrite").parquet(f"{path}/{folder}")
    added = spark.read.schema(StructType.fromDDL(state["schema"])).parquet(f"{path}/{folder}").count()
    if added:
        state = {**state, "folders": [*state["folders"], folder], "next": state["next"] + added}
        commit(spark, path, base, state)
    return state["next"] - 1


def with_keys(spark: SparkSession, path: str, rows: DataFrame, keys: str | Iterable[str], key_col: str = "surrogate_key") -> DataFrame:
    """``rows`` with their surrogate key; null where the natural key isn't registered."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    known = registered_keys(spark, path, key_col)
    if known is None:
        return rows.withColumn(key_col, F.lit(None).cast("bigint"))
    return rows.alias("r").join(known.alias("k"), _same("r", "k", keys), "left").select("r.*", f"k.{key_col}")

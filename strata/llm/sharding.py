"""Reproducible global shuffle into shards by a Feistel permutation with cycle walking.

1. Rows get global numbers 0..N-1 in the order of a hash of their key columns
   (two levels: hash bucket, then order within the bucket). Equal rows are
   counted before any shuffle, so a hot key never fills one bucket, and are
   told apart only by their running number.
2. A keyed Feistel network over [0, a*b), a*b >= N and a*b - N < a, permutes
   the numbers; a number that lands outside [0, N) walks on along its cycle
   until it is inside, which makes it a permutation of 0..N-1.
3. shard = position mod shards, slot = position div shards. Given N and the
   seed, both follow from the row number alone; shard sizes differ by at most
   one and slots have no gaps.

DataFrame and SQL functions only. Null keys are ordinary values; an empty
table gives an empty result; extra columns are not carried (join on the key).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import expand_copies

#: Hash buckets of the row numbering; the only table that one task sorts has this many rows.
BUCKETS = 1 << 14
ROUNDS = 4
#: Inlined walk beyond the first step. A cycle has at most a*b - N < a outside numbers, so for a <= WALK this is
#: always enough; for larger a each further step is taken with a probability below 1/a (checked, never assumed).
WALK = 64


def row_numbers(df: DataFrame, keys: Sequence[str], seed: int = 0, buckets: int = BUCKETS) -> DataFrame:
    """``keys`` of every row plus ``row_no`` (0..N-1) and ``n_rows`` (N).

    The order is that of a seeded hash of the keys, then of the keys. Rows that
    are equal in all keys are interchangeable and get consecutive numbers.
    """
    keys = list(keys)
    counted = df.select(*keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("__copies"))
    marked = [F.coalesce(F.col(k).cast("string"), F.lit("\0")) for k in keys]
    counted = counted.withColumn("__h", F.xxhash64(F.lit(seed), *marked))
    counted = counted.withColumn("__b", F.pmod("__h", F.lit(buckets)).cast("int"))
    sizes = counted.groupBy("__b").agg(F.sum("__copies").alias("__in_bucket"))
    # At most `buckets` rows from here to the join.
    upto = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sizes = sizes.select(
        "__b",
        (F.sum("__in_bucket").over(upto) - F.col("__in_bucket")).alias("__before"),
        F.sum("__in_bucket").over(everything).alias("n_rows"),
    )
    order = Window.partitionBy("__b").orderBy("__h", *keys)
    placed = counted.withColumn(
        "__upto", F.sum("__copies").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ).join(F.broadcast(sizes), "__b")
    first = F.col("__before") + F.col("__upto") - F.col("__copies")
    each = expand_copies(placed.select(*keys, "n_rows", "__copies", first.alias("__first")), "__copies", "__copy")
    return each.select(*keys, "n_rows", (F.col("__first") + F.col("__copy")).alias("row_no"))


def _feistel(x: Column, a: Column, b: Column, seed: int) -> Column:
    """One application of the network over [0, a*b): left in [0, a), right in [0, b)."""
    left, right = F.floor(x / b), F.pmod(x, b)
    left = (x - right) / b  # exact: the difference is a multiple of b
    left = left.cast("bigint")
    for k in range(ROUNDS):
        if k % 2 == 0:
            left = F.pmod(left + F.pmod(F.xxhash64(right, F.lit(seed), F.lit(k)), a), a)
        else:
            right = F.pmod(right + F.pmod(F.xxhash64(left, F.lit(seed), F.lit(k)), b), b)
    return left * b + right


def feistel_position(x: Column, n: Column, a: Column, b: Column, seed: int) -> Column:
    """Position of row number ``x`` under the permutation of 0..n-1 (a, b as in ``permute``)."""
    once = _feistel(x, a, b, seed)
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALK)),
        once,
        lambda y, _: F.when(y < n, y).otherwise(_feistel(y, a, b, seed)),
    )
    return F.when(once < n, once).otherwise(walked)


def permute(numbered: DataFrame, seed: int = 0) -> DataFrame:
    """Add ``position``: the Feistel permutation of ``row_no`` over 0..n_rows-1."""
    n = F.col("n_rows")
    sides = numbered.withColumn("__a", F.ceil(F.sqrt(n.cast("double"))).cast("bigint"))
    sides = sides.withColumn("__b", F.expr("(n_rows + __a - 1) div __a"))
    out = sides.withColumn("position", feistel_position(F.col("row_no"), n, F.col("__a"), F.col("__b"), seed))
    inside = F.when(F.col("position") < n, F.col("position")).otherwise(
        F.raise_error(F.lit("cycle walk did not end")).cast("bigint")
    )
    return out.withColumn("position", inside).drop("__a", "__b")


def shard(df: DataFrame, keys: Sequence[str], shards: int = 8, seed: int = 0) -> DataFrame:
    """One row per row of ``df``: its ``keys``, row_no, position, shard and slot."""
    if shards < 1:
        raise ValueError("shards must be positive")
    out = permute(row_numbers(df, keys, seed), seed)
    return out.select(
        *keys,
        "row_no",
        "position",
        F.pmod("position", F.lit(shards)).cast("int").alias("shard"),
        F.expr(f"position div {int(shards)}").alias("slot"),
    )

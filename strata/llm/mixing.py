"""Mixing sources to target weights by a time-varying curriculum.

Every source has a target: the words the mix takes from it. Its weight over
training time t in [0, 1] is its target times a piecewise-linear profile of
area one, so the integral of the weight up to t is the source's cumulative
token demand D(t), with D(1) = target. The source's documents are laid end to
end in the order of a hash, once per pass; the word at offset c is due at the
t with D(t) = c. A document's occurrence gets the position of its first word;
words at offsets from the target on are not taken. Sorting the occurrences by
position (a range partitioning) gives the training order.

Null sources form a source of their own, null texts have no words. Documents
of no words take none and get the position of their offset if there is one.
Rows equal in source, id, text and size are counted before the shuffle and
told apart by running number. Empty tables give empty results. A mix names
its sources, so their number is taken to be moderate (one task ranks them);
documents are never gathered by source: each source is split by hash prefix.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import expand_copies

#: Weights dealt to the sources in code-point order, repeating.
WEIGHTS = (3, 1, 2)
#: Profiles dealt likewise: (time, relative weight) knots, linear between them.
PROFILES = (
    ((0.0, 1.5), (1.0, 0.5)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.25), (0.5, 1.0), (1.0, 1.75)),
)
#: Hash prefixes that each source's running sum is split by.
SPLITS = 256
_WORDS = r"[^\x20\x09-\x0D]+"


def n_words(col: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(col), F.lit(_WORDS)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: tuple[int, int] = (3, 2), limit: int = 2):
    """Per source of ``sizes`` (source, source_size): rank, weight and target.

    The sources share share[0]/share[1] of all words by weight; a target stops
    at ``limit`` times its source's size and the excess is reshared by weight
    until none is above. Resharing ends where min(limit * size, level * weight)
    sums to the total, so the sources are filled in the order of the level at
    which each stops.
    """
    num, den = share
    by_code_point = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("rank", F.row_number().over(by_code_point) - 1)
    weight = F.element_at(F.array(*[F.lit(int(w)).cast("bigint") for w in weights]), (F.col("rank") % len(weights)) + 1)
    ranked = ranked.withColumn("weight", weight)
    # Times `den`, all amounts are whole numbers.
    cap = F.col("source_size") * (limit * den)
    full_at = Window.orderBy((F.col("source_size") / F.col("weight")).asc(), "rank")
    before = full_at.rowsBetween(Window.unboundedPreceding, -1)
    onward = full_at.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    filled = ranked.select(
        "*",
        cap.alias("__cap"),
        (F.sum("source_size").over(whole) * num).alias("__total"),
        F.coalesce(F.sum(cap).over(before), F.lit(0)).alias("__capped"),
        F.sum("weight").over(onward).alias("__open_weight"),
    )
    # A source stops at its cap if the level reached without it being capped is at or above its own.
    filled = filled.withColumn("__left", F.col("__total") - F.col("__capped"))
    stops = F.col("__cap") * F.col("__open_weight") <= F.col("__left") * F.col("weight")
    filled = filled.withColumn("__stops", stops)
    # The level: of the first source that doesn't stop (all later ones share it).
    level = F.min(F.when(~F.col("__stops"), F.struct("__capped", "__left", "__open_weight"))).over(whole)
    filled = filled.withColumn("__level", level)
    target = F.when(F.col("__stops"), F.col("__cap") / F.lit(float(den))).otherwise(
        (F.col("weight") * F.col("__level.__left")).cast("double") / (F.col("__level.__open_weight") * den).cast("double")
    )
    return filled.select("source", "source_size", "rank", "weight", target.alias("target"))


def _knots(profile: Sequence[tuple[float, float]]) -> list[tuple[float, float, float, float, float]]:
    """Segments (t0, t1, w0, w1, area before) of the profile scaled to area one."""
    area = sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(profile, profile[1:], strict=False))
    out, done = [], 0.0
    for (t0, w0), (t1, w1) in zip(profile, profile[1:], strict=False):
        out.append((t0, t1, w0 / area, w1 / area, done))
        done += (t1 - t0) * (w0 + w1) / 2 / area
    return out


def due(share: Column, profile: Sequence[tuple[float, float]]) -> Column:
    """The t at which the profile's integral reaches ``share`` (0 to 1), in closed form per segment."""
    out = None
    for t0, t1, w0, w1, done in reversed(_knots(profile)):
        rest, slope = share - F.lit(done), (w1 - w0) / (t1 - t0)
        if slope == 0.0:
            t = F.lit(t0) + rest / F.lit(w0)
        else:  # w0 x + slope x^2 / 2 = rest, in the form that loses no digits
            root = F.sqrt(F.greatest(F.lit(w0 * w0) + F.lit(2.0 * slope) * rest, F.lit(0.0)))
            t = F.lit(t0) + F.lit(2.0) * rest / (F.lit(w0) + root)
        out = t if out is None else F.when(share < F.lit(done_next), t).otherwise(out)
        done_next = done
    return out


def mix(docs: DataFrame, profiles=PROFILES, weights=WEIGHTS, share=(3, 2), limit: int = 2, also: Sequence[str] = ()) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source; of the others those in ``also`` are carried).

    doc_id, source, text_md5, copy (running number among rows equal in all of
    these), size, source_size, target, offset (of its first word in one pass
    over its source), taken (words the mix takes from it, over all passes) and
    passes: an array of (pass, taken, position) of its occurrences in the mix.
    """
    sized = docs.select("source", "doc_id", F.md5("text").alias("text_md5"), n_words().alias("size"), *also)
    keys = ["source", "doc_id", "text_md5", "size", *also]
    rows = sized.groupBy(*keys).agg(F.count(F.lit(1)).alias("__copies"))
    blank = F.lit("")
    mark = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), blank), F.coalesce(F.col("text_md5"), blank))
    rows = rows.withColumn("__h", F.md5(mark)).withColumn("__words", F.col("size") * F.col("__copies"))
    rows = rows.withColumn("__part", F.conv(F.substring("__h", 1, 4), 16, 10).cast("int") % F.lit(SPLITS))
    part_sizes = rows.groupBy("source", "__part").agg(F.sum("__words").alias("__in_part"))
    earlier = Window.partitionBy("source").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = part_sizes.withColumn("__before", F.coalesce(F.sum("__in_part").over(earlier), F.lit(0)))
    plan = targets(part_sizes.groupBy("source").agg(F.sum("__in_part").alias("source_size")), weights, share, limit)
    named = offsets.alias("o").join(plan.alias("p"), F.col("o.source").eqNullSafe(F.col("p.source")))
    named = named.select(F.col("o.source").alias("__source"), F.col("o.__part").alias("__p"), "__before", "source_size", "rank", "target")
    upto = Window.partitionBy("source", "__part").orderBy("__h", *keys[1:]).rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("__inside", F.coalesce(F.sum("__words").over(upto), F.lit(0)))
    placed = placed.join(named, F.col("source").eqNullSafe(F.col("__source")) & (F.col("__part") == F.col("__p")))
    each = expand_copies(placed, "__copies", "copy")
    each = each.withColumn("offset", F.col("__before") + F.col("__inside") + F.col("copy") * F.col("size"))
    end = F.floor("target")
    occurrences = []
    for p in range(limit):
        at = F.col("offset") + F.lit(p) * F.col("source_size")
        got = F.greatest(F.least(end - at, F.col("size")), F.lit(0)).cast("bigint")
        quota = F.try_divide(at.cast("double"), F.col("target"))
        when = None
        for k, profile in enumerate(profiles):
            rule = F.when(F.col("rank") % len(profiles) == k, due(quota, profile))
            when = rule if when is None else F.coalesce(when, rule)
        occurrences.append(F.when(at < F.col("target"), F.struct(F.lit(p).alias("pass"), got.alias("taken"), when.alias("position"))))
    each = each.withColumn("passes", F.array_compact(F.array(*occurrences)))
    taken = F.aggregate("passes", F.lit(0).cast("bigint"), lambda acc, x: acc + x["taken"])
    return each.select(
        "doc_id", "source", "text_md5", "copy", "size", "source_size", "target", "offset", taken.alias("taken"), "passes", *also
    )


def by_position(mixed: DataFrame) -> DataFrame:
    """The rows of a mix in training order: range-sorted by the position of their first occurrence.

    Rows of one position (empty documents) are told apart by the columns that follow, so they
    are split among tasks too; rows without an occurrence come last.
    """
    first = F.get("passes", F.lit(0))["position"]
    return mixed.orderBy(first.asc_nulls_last(), "source", "doc_id", "text_md5", "copy")


def in_order(docs: DataFrame, **options) -> DataFrame:
    """The rows of the mix, all columns of ``docs``, range-sorted by their training position.

    Texts stay whole: an occurrence is kept if the mix takes at least half of its words (one
    occurrence per source is cut by its target). Rows equal in all columns are counted, so
    they share one copy of their text until the sort.
    """
    columns = docs.columns
    marked = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\0")) for c in columns]
    rows = docs.withColumn("__row", F.md5(F.concat_ws("\1", *marked)))
    due_ = mix(rows, also=["__row"], **options)
    kept = F.filter("passes", lambda x: (x["taken"] > 0) & (x["taken"] * 2 >= F.col("size")))
    due_ = due_.select("__row", F.explode(F.transform(kept, lambda x: x["position"])).alias("__position"))
    texts = rows.groupBy("__row").agg(F.first(F.struct(*[F.col(f"`{c}`") for c in columns])).alias("__doc"))
    sorted_ = texts.join(due_, "__row").orderBy("__position", "__row")
    return sorted_.select(*[F.col("__doc").getField(c).alias(c) for c in columns])

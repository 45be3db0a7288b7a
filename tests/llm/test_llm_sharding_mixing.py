from __future__ import annotations

import random
import struct
from collections import Counter, defaultdict

import pytest
import xxhash
from llm_cases import WORD, table
from pyspark.sql import functions as F

from strata.llm import mixing, queries, sharding


def _hash(*values: tuple[int, str]) -> int:
    """Spark's xxhash64 of longs and ints, chained from seed 42."""
    h = 42
    for v, form in values:
        h = xxhash.xxh64_intdigest(struct.pack(form, v), h)
    return h - 2**64 if h >= 2**63 else h


def _position(x: int, n: int, seed: int) -> int:
    a = int(-(-(n**0.5) // 1))
    b = (n + a - 1) // a
    while True:
        left, right = divmod(x, b)
        for k in range(sharding.ROUNDS):
            if k % 2 == 0:
                left = (left + _hash((right, "<q"), (seed, "<i"), (k, "<i")) % a) % a
            else:
                right = (right + _hash((left, "<q"), (seed, "<i"), (k, "<i")) % b) % b
        x = left * b + right
        if x < n:
            return x


@pytest.mark.parametrize("n", [1, 2, 3, 5, 17, 100, 1023])
def test_feistel_walk_against_a_plain_loop(spark, n):
    numbered = spark.range(n).select(F.col("id").alias("row_no"), F.lit(n).cast("bigint").alias("n_rows"))
    got = {r["row_no"]: r["position"] for r in sharding.permute(numbered, seed=7).collect()}
    assert got == {x: _position(x, n, 7) for x in range(n)}
    assert sorted(got.values()) == list(range(n))


def test_row_numbers_have_no_gaps_under_hot_and_null_keys(spark):
    rows = [(None,)] * 70 + [(5,)] * 200 + [(i,) for i in range(100)]
    random.Random(1).shuffle(rows)
    out = sharding.shard(spark.createDataFrame(rows, "k long").repartition(5), ["k"], shards=7).collect()
    assert sorted(r["row_no"] for r in out) == list(range(len(rows)))
    assert Counter(r["k"] for r in out) == Counter(k for (k,) in rows)
    by_shard = defaultdict(list)
    for r in out:
        by_shard[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in by_shard.values())
    assert max(map(len, by_shard.values())) - min(map(len, by_shard.values())) <= 1


def test_shards_do_not_depend_on_the_input_order(spark):
    rows = [(i, i % 3) for i in range(300)]
    runs = []
    for parts in (1, 6):
        random.Random(parts).shuffle(rows)
        df = spark.createDataFrame(rows, "k long, s int").repartition(parts)
        runs.append(sorted(map(tuple, sharding.shard(df, ["k", "s"]).collect())))
    assert runs[0] == runs[1]


@pytest.mark.parametrize("profile", mixing.PROFILES + (((0.0, 2.0), (0.3, 0.0), (0.7, 1.0), (1.0, 1.0)),))
def test_due_inverts_the_integral(spark, profile):
    def integral(t: float) -> float:
        area = done = 0.0
        for (t0, w0), (t1, w1) in zip(profile, profile[1:], strict=False):
            area += (t1 - t0) * (w0 + w1) / 2
            x = min(max(t - t0, 0.0), t1 - t0)
            done += w0 * x + (w1 - w0) / (t1 - t0) * x * x / 2
        return done / area

    shares = spark.range(101).select((F.col("id") / 101).alias("s"))
    for r in shares.select("s", mixing.due(F.col("s"), profile).alias("t")).collect():
        assert abs(integral(r["t"]) - r["s"]) < 1e-9


def _targets(sizes: dict) -> dict:
    """Reshare the excess by weight again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    fixed, rest = {}, 1.5 * sum(sizes.values())
    while True:
        free = [s for s in names if s not in fixed]
        level = rest / max(1, sum(weight[s] for s in free))
        over = [s for s in free if level * weight[s] >= 2 * sizes[s]]
        if not over:
            return fixed | {s: level * weight[s] for s in free}
        for s in over:
            fixed[s] = 2.0 * sizes[s]
            rest -= fixed[s]


def test_mix_against_brute_force(spark):
    docs = table(spark)
    sizes, per_doc = Counter(), Counter()
    for r in docs.collect():
        n = len(WORD.findall(r["text"] or ""))
        sizes[r["source"]] += n
        per_doc[r["doc_id"]] += n
    out = mixing.mix(docs).collect()
    expected = _targets(dict(sizes))
    taken = Counter()
    for r in out:
        taken[r["source"]] += r["taken"]
        assert 0 <= r["taken"] <= 2 * r["size"]
        assert r["source_size"] == sizes[r["source"]]
        assert abs(r["target"] - expected[r["source"]]) < 1e-6
        assert all(0 <= p["position"] < 1 for p in r["passes"])
        assert r["taken"] == sum(p["taken"] for p in r["passes"])
    for source, target in expected.items():
        assert target - 1 <= taken[source] <= target
    assert sum(r["size"] for r in out) == sum(per_doc.values())


def test_curriculum_order_and_repeats(spark):
    docs = table(spark, extra=True)
    out = mixing.in_order(docs)
    assert out.columns == docs.columns
    rows = [r["source"] for r in out.collect()]
    # In code-point order "" and src2 fade out, src1 fades in (src0 and src3 stay even).
    half = len(rows) // 2
    early, late = Counter(rows[:half]), Counter(rows[half:])
    assert early["src2"] / max(late["src2"], 1) > early["src1"] / max(late["src1"], 1)
    times = Counter(r["doc_id"] for r in out.collect())
    assert max(times.values()) <= 4  # two rows of id 104, twice each


def test_query_returns_the_curriculum_order(spark, scratch):
    table(spark, extra=True).repartition(5).write.parquet(f"{scratch}/documents.parquet")
    out = queries.QUERIES["op5_mixing"](spark, scratch)
    rows = [r["position"] for r in out.collect()]
    taken = [p for p in rows if p is not None]
    assert len(taken) > 10 and taken == sorted(taken)
    assert rows[len(taken) :] == [None] * (len(rows) - len(taken))
    assert "rangepartitioning" in out._jdf.queryExecution().executedPlan().toString()


def test_sources_without_words(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    out = mixing.mix(docs).collect()
    assert [(r["size"], r["target"], r["taken"], r["passes"]) for r in out] == [(0, 0.0, 0, [])] * 2

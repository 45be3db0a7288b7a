"""Nearest neighbours by largest inner product: one vantage-point tree per shard.

Inner products are turned into distances by one more coordinate: a vector x
becomes (x, sqrt(M^2 - |x|^2)) and a query q becomes (q, 0), M being the
largest norm of the shard; then |q' - x'|^2 = |q|^2 + M^2 - 2 q.x, so the
nearest are those with the largest product, and the triangle inequality holds.

Equal vectors are indexed once, with the k + 1 smallest of their ids: no
further copy can be among k results, since ties go to the smaller id. Distinct
vectors are dealt to shards by hash, ``shard_rows`` on average (fewer where
they are so long that a shard would exceed SHARD_BYTES); each shard builds its
tree (a vantage point, the median distance, the two halves) once, in one task,
and the packed trees are written. Queries are packed in blocks by hash of their
id. Every block is copied to every shard, where the blocks of a lane (LANE of
them) are searched one after another beside the shard's tree: vectors travel
once per lane, and a task holds one tree and one block. The k best of each
block and shard are merged per query.

A subtree is left out when its bound exceeds factor * (k-th best distance so
far). With factor 1 that is the triangle inequality, and the search is exact;
smaller factors visit less and may miss neighbours.

Distances only prune, with a margin for their rounding, which grows with M;
what is kept is decided by the products themselves, added up in double
precision from the first component on, and ties go to the smaller id. As M
sets the margin, a shard's vectors of far larger norm than its median have a
tree of their own.

Left out everywhere: null ids, null or zero vectors, vectors with null or
non-finite components. Several rows of one id count as one (the smallest
vector). Only vectors of a query's own length are its candidates. An empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import prepare, stored

LEAF = 256
#: Kept beyond the k wanted while searching: the query's own vector.
SPARE = 1
#: Norms above this multiple of the shard's median are searched apart.
OUTLIER = 16
#: Pairs whose products are added up at once.
PAIRS = 1 << 15
SHARD_ROWS = 8192
QUERY_ROWS = 1024
#: Bytes of a shard's or a block's numbers at most.
SHARD_BYTES = 64 << 20
#: Query blocks that search one copy of a tree.
LANE = 64
#: Partitions of the search at most; beyond, a task has several trees, one after another.
SEARCHES = 1 << 15

TREE = "dim int, shard bigint, piece int, points binary, ids binary, counts binary, nodes binary, medians binary"
BLOCK = "dim int, block bigint, points binary, ids binary"


def usable(vector: Column) -> Column:
    """True for vectors that take part."""
    numbers = F.transform(vector, lambda x: x.cast("double"))
    sound = F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & sound & F.exists(numbers, lambda x: x != 0), F.lit(False))


@dataclass
class _Tree:
    """Rows reordered so that every subtree is a slice; nodes are (lo, hi) slices."""

    points: np.ndarray  # augmented, in tree order
    order: np.ndarray  # tree order -> input row
    vantage: dict[tuple[int, int], tuple[float, int]]  # slice -> (median distance, split); the vantage point is row lo


def build(vectors: np.ndarray, leaf: int = LEAF) -> _Tree:
    norms = (vectors * vectors).sum(axis=1)
    extra = np.sqrt(np.maximum(norms.max(initial=0.0) - norms, 0.0))
    points = np.column_stack([vectors, extra])
    order = np.arange(len(points))
    nodes: dict[tuple[int, int], tuple[float, int]] = {}
    rng = np.random.default_rng(7)
    stack = [(0, len(points))]
    while stack:
        lo, hi = stack.pop()
        if hi - lo <= leaf:
            continue
        pick = lo + int(rng.integers(hi - lo))
        order[[lo, pick]] = order[[pick, lo]]
        rest = order[lo + 1 : hi]
        d = np.sqrt(((points[rest] - points[order[lo]]) ** 2).sum(axis=1))
        by = np.argsort(d, kind="stable")
        order[lo + 1 : hi] = rest[by]
        split = lo + 1 + (hi - lo - 1) // 2
        nodes[lo, hi] = (float(d[by[split - lo - 1]]), split)  # inner half: at most the median; outer: at least
        stack += [(lo + 1, split), (split, hi)]
    return _Tree(points[order], order, nodes)


class _Search:
    """k nearest of one tree for a block of queries, all queries of a node at once; ties go to the smaller of ``ids``."""

    def __init__(self, tree: _Tree, queries: np.ndarray, k: int, factor: float, ids: np.ndarray | None = None):
        self.tree, self.k, self.factor, self.raw = tree, k, factor, queries
        self.queries = np.column_stack([queries, np.zeros(len(queries))])
        self.vectors = tree.points[:, :-1]
        self.ids = np.asarray(tree.order if ids is None else ids[tree.order], dtype=np.int64)
        self.score = np.full((len(queries), k), -np.inf)  # best first
        self.found = np.full((len(queries), k), -1)
        self.id = np.full((len(queries), k), np.iinfo(np.int64).max)
        # Bounds of rounding errors: sums of so many terms, of squares up to these.
        error = 8 * (queries.shape[1] + 8) * np.finfo(float).eps
        m2, q2 = (self.vectors * self.vectors).sum(axis=1).max(initial=0.0), (queries * queries).sum(axis=1)
        self.square = q2 + m2
        self.margin = error * np.sqrt(q2 * m2)  # of products
        self.slack = error * (np.sqrt(q2) + np.sqrt(m2))  # of distances
        self.slack2 = error * self.square  # of squared distances
        self.visited = 0
        self.visit(0, len(tree.points), np.arange(len(queries)))

    def offer(self, q: np.ndarray, lo: int, hi: int) -> None:
        """Candidates lo..hi for the queries q."""
        self.visited += len(q) * (hi - lo)
        near = self.raw[q] @ self.vectors[lo:hi].T
        least = self.score[q, -1]
        if hi - lo > self.k:
            least = np.maximum(least, np.partition(near, hi - lo - self.k, axis=1)[:, hi - lo - self.k] - self.margin[q])
        row, col = np.nonzero(~(near < (least - self.margin[q])[:, None]))
        if not len(row):
            return
        exact = np.concatenate(
            [
                np.cumsum(self.vectors[lo + col[at : at + PAIRS]] * self.raw[q[row[at : at + PAIRS]]], axis=1)[:, -1]
                for at in range(0, len(row), PAIRS)
            ]
        )
        some, row = np.unique(row, return_inverse=True)
        q, k = q[some], self.k
        rows = np.concatenate([np.repeat(np.arange(len(q)), k), row])
        score = np.concatenate([self.score[q].ravel(), exact])
        found = np.concatenate([self.found[q].ravel(), lo + col])
        ids = np.concatenate([self.id[q].ravel(), self.ids[lo + col]])
        order = np.lexsort((ids, -score, rows))
        first = np.searchsorted(rows[order], np.arange(len(q)))
        best = order[first[:, None] + np.arange(k)]
        self.score[q], self.found[q], self.id[q] = score[best], found[best], ids[best]

    def reach(self, q: np.ndarray) -> np.ndarray:
        """What the k-th best product so far is at most as a distance, times the factor."""
        worst = np.sqrt(np.maximum(self.square[q] - 2 * self.score[q, -1] + self.slack2[q], 0))
        return self.factor * worst + self.slack[q]

    def visit(self, lo: int, hi: int, q: np.ndarray) -> None:
        if not len(q) or lo >= hi:
            return
        points = self.tree.points
        node = self.tree.vantage.get((lo, hi))
        if node is None:
            self.offer(q, lo, hi)
            return
        median, split = node
        d = np.sqrt(((self.queries[q] - points[lo]) ** 2).sum(axis=1))
        self.offer(q, lo, lo + 1)
        inner_first = d <= median
        near, far = q[inner_first], q[~inner_first]
        self.visit(lo + 1, split, near)
        self.visit(split, hi, far)
        # The other half: no nearer than the distance to the border.
        self.visit(split, hi, near[~(median - d[inner_first] > self.reach(near))])
        self.visit(lo + 1, split, far[~(d[~inner_first] - median > self.reach(far))])


def _plant(key: tuple, shard: pd.DataFrame) -> pd.DataFrame:
    """The packed tree of one shard; a second one holds the vectors of far larger norm."""
    shard = shard.sort_values("mark", kind="stable")
    x = np.stack(shard["vector"].to_numpy())
    ids = shard["ids"].to_numpy()
    norm = np.sqrt((x * x).sum(axis=1))
    apart = norm > OUTLIER * np.median(norm)
    rows = []
    for piece, part in enumerate((np.flatnonzero(~apart), np.flatnonzero(apart))):
        if not len(part):
            continue
        tree = build(x[part])
        own = [np.asarray(i, dtype=np.int64) for i in ids[part[tree.order]]]
        nodes = np.array([(lo, hi, split) for (lo, hi), (_, split) in tree.vantage.items()], dtype=np.int64)
        rows.append(
            {
                "piece": piece,
                "points": tree.points.tobytes(),
                "ids": np.concatenate(own).tobytes(),
                "counts": np.array([len(i) for i in own], dtype=np.int64).tobytes(),
                "nodes": nodes.tobytes(),
                "medians": np.array([median for median, _ in tree.vantage.values()]).tobytes(),
            }
        )
    return pd.DataFrame(rows).assign(dim=key[0], shard=key[1])


def _pack(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
    points = np.stack(block["vector"].to_numpy()).tobytes()
    ids = block["vec_id"].to_numpy(dtype=np.int64).tobytes()
    return pd.DataFrame({"dim": [key[0]], "block": [key[1]], "points": [points], "ids": [ids]})


class _Planted:
    """A tree unpacked, with the ids of its vectors in tree order: ``ids[first[i] : first[i + 1]]``, smallest first."""

    def __init__(self, row):
        points = np.frombuffer(row.points).reshape(-1, row.dim + 1)
        nodes = np.frombuffer(row.nodes, dtype=np.int64).reshape(-1, 3).tolist()
        medians = np.frombuffer(row.medians).tolist()
        vantage = {(lo, hi): (median, split) for (lo, hi, split), median in zip(nodes, medians, strict=True)}
        self.tree = _Tree(points, np.arange(len(points)), vantage)
        self.ids = np.frombuffer(row.ids, dtype=np.int64)
        self.counts = np.frombuffer(row.counts, dtype=np.int64)
        self.first = np.r_[0, np.cumsum(self.counts)]

    def hits(self, query_ids: np.ndarray, queries: np.ndarray, k: int, factor: float) -> pd.DataFrame:
        found = _Search(self.tree, queries, min(k + SPARE, len(self.counts)), factor, self.ids[self.first[:-1]])
        rows, at = np.nonzero(found.found >= 0)
        vectors = found.found[rows, at]
        copies = self.counts[vectors]
        hit = np.repeat(np.arange(len(vectors)), copies)
        nth = np.arange(len(hit)) - np.repeat(np.cumsum(copies) - copies, copies)
        ids = self.ids[self.first[vectors[hit]] + nth]
        return pd.DataFrame({"query_id": query_ids[rows[hit]], "vec_id": ids, "score": found.score[rows, at][hit]})


def _search(k: int, factor: float):
    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come by shard and lane: its trees, then its blocks."""
        trees: list[_Planted] = []
        now = None
        for batch in batches:
            for row in batch.itertuples(index=False):
                if (row.dim, row.shard, row.lane) != now:
                    now, trees = (row.dim, row.shard, row.lane), []
                if row.block < 0:
                    trees.append(_Planted(row))
                    continue
                query_ids = np.frombuffer(row.ids, dtype=np.int64)
                queries = np.frombuffer(row.points).reshape(len(query_ids), -1)
                hit = pd.concat([t.hits(query_ids, queries, k, factor) for t in trees], ignore_index=True)
                hit = hit[hit["vec_id"] != hit["query_id"]]
                hit = hit.sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
                yield hit.groupby("query_id").head(k)

    return search


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    factor: float = 1.0,
    shard_rows: int = SHARD_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of the k nearest found; ``vectors`` has vec_id and embedding."""
    prepare(vectors.sparkSession)  # packed rows are large: batches are bounded by bytes
    doubles = F.transform("embedding", lambda x: x.cast("double"))
    clean = vectors.select("vec_id", "embedding").where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    clean = clean.groupBy("vec_id").agg(F.min(doubles).alias("vector"))
    clean = clean.withColumn("mark", F.xxhash64("vector")).withColumn("dim", F.size("vector"))
    clean = stored(clean, "vectors")
    by_vector = Window.partitionBy("mark", "vector").orderBy("vec_id")
    first_ids = clean.withColumn("r", F.row_number().over(by_vector)).where(F.col("r") <= k + 1)
    distinct = first_ids.groupBy("mark", "vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"), F.first("dim").alias("dim"))

    def pieces(rows: Column, most: int) -> Column:
        fit = F.greatest(F.lit(1), F.floor(F.lit(SHARD_BYTES) / (8 * (F.col("dim") + 1))))
        return F.greatest(F.lit(1), F.ceil(rows / F.least(F.lit(most), fit))).cast("bigint")

    # Shards and query blocks per vector length, sized by count.
    asked = F.coalesce(is_query, F.lit(False))
    sizes = clean.groupBy("dim").agg(
        pieces(F.count("*"), shard_rows).alias("shards"), pieces(F.count_if(asked), query_rows).alias("blocks")
    )
    sizes = stored(sizes.withColumn("lanes", F.ceil(F.col("blocks") / LANE).cast("bigint")), "sizes")

    def numbers(upto: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(upto) - 1))

    dealt = distinct.join(sizes, "dim").withColumn("shard", F.pmod("mark", F.col("shards")))
    trees = dealt.select("dim", "shard", "mark", "ids", "vector").groupBy("dim", "shard")
    trees = stored(trees.applyInPandas(_plant, TREE), "trees")
    blocks = clean.where(asked).join(sizes, "dim").withColumn("block", F.pmod(F.xxhash64("vec_id"), F.col("blocks")))
    blocks = blocks.select("dim", "block", "vec_id", "vector").groupBy("dim", "block")
    blocks = stored(blocks.applyInPandas(_pack, BLOCK), "blocks")
    # Every block goes to every shard of its length, a shard's tree to every lane.
    lanes = trees.join(sizes, "dim").withColumn("lane", numbers("lanes")).withColumn("block", F.lit(-1).cast("bigint"))
    copies = blocks.join(sizes, "dim").withColumn("shard", numbers("shards")).withColumn("lane", F.floor(F.col("block") / LANE).cast("bigint"))
    rows = lanes.drop("shards", "blocks", "lanes").unionByName(copies.drop("shards", "blocks", "lanes"), allowMissingColumns=True)
    searches = sizes.agg(F.sum(F.col("shards") * F.col("lanes"))).first()[0] or 1
    keys = ["dim", "shard", "lane"]
    rows = rows.repartition(min(searches, SEARCHES), *keys).sortWithinPartitions(*keys, "block", "piece")
    hits = rows.mapInPandas(_search(k, factor), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

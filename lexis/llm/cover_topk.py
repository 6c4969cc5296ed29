"""Exact top-k inner-product search with a cover tree over queries and data.

The tree's centres are fitted on a bounded sample (``SAMPLE`` vectors, those
with the smallest hash of the id): level by level the covering radius halves
and a node's centres are chosen so that every sample vector of the node lies
within the radius of one.  All vectors, queries and data together, descend to
their nearest centre; the covering radii that are used are measured over all
vectors, separately for queries and data, so pruning is exact whatever the
sample was.

For a query node with centre q and radius r and a data node with centre p and
radius s no product exceeds <q, p> + r |p| + s |q| + r s.

1. Each query is scored against the data of its own leaf and the leaves nearest
   to that; its kth score is a lower bound.  The worst bound in a query group
   is the group's.
2. The dual-tree walk starts with the pair of roots and splits the wider node
   of each pair; a pair whose bound stays below the query node's worst kth
   score is pruned.  The walk runs over nodes, whose number the sample limits,
   not over vectors.
3. Queries travel in blocks; a data block meets a query block if one of their
   leaf pairs survived.  Inside, each surviving pair of leaves is one matrix
   product of integers; only scores that reach the query's bound go on, at most
   k for each query and data block.

Nothing is broadcast that grows with the table but the walk's result (at most
leaves squared).  Components are floor(256 x); products are exact (float64
while all sums stay below 2**53, else Python integers of numpy's object type).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexis.llm.common import Stored

SAMPLE = 4096
LEAF_SHARE = 16                # sample vectors in a leaf, about
BLOCK_ROWS = 1024
SEED_LEAVES = 4
SLACK = 1e-6


@dataclass
class Tree:
    """Nodes by number; children of a node are a run of numbers."""
    centre: np.ndarray
    parent: np.ndarray
    first: np.ndarray          # first child, -1 for a leaf
    count: np.ndarray

    def descend(self, v: np.ndarray) -> np.ndarray:
        """The leaf of each vector: from the root always to the nearest child."""
        at = np.zeros(len(v), np.int64)
        todo = [(0, np.arange(len(v)))]
        while todo:
            node, rows = todo.pop()
            if self.first[node] < 0 or len(rows) == 0:
                at[rows] = node
                continue
            kids = np.arange(self.first[node], self.first[node] + self.count[node])
            c = self.centre[kids]
            near = np.argmin((c * c).sum(1) - 2 * (v[rows] @ c.T), axis=1)
            for i, k in enumerate(kids):
                part = rows[near == i]
                if len(part):
                    todo.append((int(k), part))
        return at

    def path(self, leaf: int) -> list[int]:
        out = [leaf]
        while self.parent[out[-1]] >= 0:
            out.append(int(self.parent[out[-1]]))
        return out


def fit_tree(sample: np.ndarray, leaf_rows: int = LEAF_SHARE) -> Tree:
    """Centres by halving radii: each node's sample is covered greedily, farthest vector first."""
    dim = sample.shape[1]
    root = sample.mean(0) if len(sample) else np.zeros(dim)
    centre, parent, first, count = [root], [-1], [-1], [0]
    todo = [(0, np.arange(len(sample)))]
    while todo:
        node, rows = todo.pop(0)
        if len(rows) <= leaf_rows:
            continue
        x = sample[rows]
        dist = np.linalg.norm(x - centre[node], axis=1)
        radius = dist.max() / 2
        if radius <= 0:
            continue
        picks, own = [int(np.argmin(dist))], None
        gap = np.linalg.norm(x - x[picks[0]], axis=1)
        own = np.zeros(len(rows), np.int64)
        while gap.max() > radius and len(picks) < 16:
            picks.append(int(np.argmax(gap)))
            d = np.linalg.norm(x - x[picks[-1]], axis=1)
            own = np.where(d < gap, len(picks) - 1, own)
            gap = np.minimum(d, gap)
        if len(picks) < 2:
            picks.append(int(np.argmax(gap)))
            d = np.linalg.norm(x - x[picks[-1]], axis=1)
            own = np.where(d < gap, 1, own)
        first[node], count[node] = len(centre), len(picks)
        for i, p in enumerate(picks):
            centre.append(x[p])
            parent.append(node)
            first.append(-1)
            count.append(0)
            todo.append((len(centre) - 1, rows[own == i]))
    return Tree(np.array(centre).reshape(len(centre), dim), np.array(parent), np.array(first), np.array(count))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of integer rows: exact, and held at -LARGEST or LARGEST beyond 64 bits."""
    if not a.size or not b.size or float(np.abs(a.astype(np.float64)).max()) * float(np.abs(b.astype(np.float64)).max()) * a.shape[1] < 2.0 ** 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    whole = a.astype(object) @ b.astype(object).T
    return np.minimum(np.maximum(whole, -LARGEST), LARGEST).astype(np.int64)


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    """Integer rows of a list column, short ones filled with 0."""
    out = np.zeros((len(col), dim), np.int64)
    values, offsets = np.asarray(col.flatten()), np.asarray(col.offsets)
    offsets = offsets - offsets[0]
    size = np.diff(offsets)
    if len(size) and (size == dim).all():
        return values.reshape(len(col), dim).astype(np.int64)
    for i, n in enumerate(size):
        out[i, :n] = values[offsets[i]:offsets[i] + n]
    return out


def walk(tree: Tree, rq: np.ndarray, rd: np.ndarray, worst: np.ndarray, has_q: np.ndarray, has_d: np.ndarray) -> list[tuple[int, int]]:
    """Leaf pairs (query, data) that the dual-tree walk can't prune.  rq, rd:
    covering radius of each node for queries and data; worst: the worst kth
    score among the node's queries."""
    norm = np.linalg.norm(tree.centre, axis=1)
    out, q, d = [], np.array([0]), np.array([0])
    while len(q):
        live = has_q[q] & has_d[d]
        q, d = q[live], d[live]
        bound = (tree.centre[q] * tree.centre[d]).sum(1) + rq[q] * norm[d] + rd[d] * norm[q] + rq[q] * rd[d]
        live = bound + SLACK * (1 + np.abs(bound)) >= worst[q]
        q, d = q[live], d[live]
        leaf_q, leaf_d = tree.first[q] < 0, tree.first[d] < 0
        both = leaf_q & leaf_d
        out += zip(q[both].tolist(), d[both].tolist())
        q, d, leaf_q, leaf_d = q[~both], d[~both], leaf_q[~both], leaf_d[~both]
        split_q = ~leaf_q & (leaf_d | (rq[q] >= rd[d]))
        nq, nd = [], []
        for side, (x, y) in ((split_q, (q, d)), (~split_q, (d, q))):
            x, y = x[side], y[side]
            rep = np.repeat(np.arange(len(x)), tree.count[x])
            kids = tree.first[x][rep] + (np.arange(len(rep)) - np.repeat(np.cumsum(tree.count[x]) - tree.count[x], tree.count[x]))
            a, b = (kids, y[rep]) if side is split_q else (y[rep], kids)
            nq.append(a)
            nd.append(b)
        q, d = np.concatenate(nq).astype(np.int64), np.concatenate(nd).astype(np.int64)
    return out


def _top(ids_q, ids_d, score, bound, k):
    """(query, vector, score) of each query's best k that reach its bound, ties to the smaller id."""
    out = []
    for i in range(len(ids_q)):
        pick = np.flatnonzero((score[i] >= bound[i]) & (ids_d != ids_q[i]))
        if len(pick) > k:
            cut = np.partition(score[i][pick], len(pick) - k)[len(pick) - k]
            pick = pick[score[i][pick] >= cut]
            pick = pick[np.lexsort((ids_d[pick], -score[i][pick]))[:k]]
        out.append((np.full(len(pick), ids_q[i]), ids_d[pick], score[i][pick]))
    return [np.concatenate(x) if x else np.zeros(0, np.int64) for x in zip(*out)] if out else [np.zeros(0, np.int64)] * 3


#: what stands for "no score yet"; scores lie between -LARGEST and LARGEST
LOWEST = np.iinfo(np.int64).min
LARGEST = np.iinfo(np.int64).max


class TopK:
    """See the module's text.  Vectors that are null or hold null or non-finite
    components take no part; shorter vectors count as filled with 0; null ids
    take no part; of rows with the same id each is a candidate of its own (a
    query is the first of its id by vector).  Components and scores beyond 64 bits are
    held at the ends of their range.  An empty table gives an empty result."""

    def __init__(self, vectors: DataFrame, queries_where, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
                 block_rows: int = BLOCK_ROWS, sample: int = SAMPLE):
        self.k, self.block_rows = k, block_rows
        spark = vectors.sparkSession
        self.stored = Stored(spark, "topk")
        x = F.transform(F.col(vec_col), lambda v: v.cast("double"))
        fine = F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & F.forall(
            x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
        good = vectors.where(F.coalesce(fine, F.lit(False))).select(
            F.col(id_col).cast("long").alias("id"), F.transform(x, lambda v: F.floor(v * 256.0)).cast("array<long>").alias("v"))
        good = good.withColumn("is_query", queries_where(F.col("id")))
        dim = good.agg(F.max(F.size("v"))).first()[0]
        self.dim = int(dim or 0)
        picked = good.select("id", "v").orderBy(F.xxhash64("id"), "id").limit(sample).toArrow()      # at most `sample` vectors
        self.tree = fit_tree(_matrix(picked["v"].combine_chunks(), self.dim).astype(np.float64))
        self.placed = self.stored.put(good.mapInArrow(self._place(), "leaf int, id long, v array<long>, is_query boolean, far array<double>"))
        self._measure()

    def _place(self):
        tree, dim = self.tree, self.dim
        paths = {int(n): tree.path(int(n)) for n in np.flatnonzero(tree.first < 0)}

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                v = _matrix(b.column(1), dim).astype(np.float64)
                leaf = tree.descend(v) if len(v) else np.zeros(0, np.int64)
                far = [np.linalg.norm(tree.centre[paths[n]] - x, axis=1) for n, x in zip(leaf.tolist(), v)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(leaf.astype(np.int32)), b.column(0), b.column(1), b.column(2), pa.array(far, pa.list_(pa.float64()))],
                    ["leaf", "id", "v", "is_query", "far"])
        return run

    def _measure(self) -> None:
        """Covering radii of all nodes over all vectors: one row for each leaf, side and ancestor."""
        n = len(self.tree.centre)
        self.rq, self.rd = np.zeros(n), np.zeros(n)
        self.has_q, self.has_d = np.zeros(n, bool), np.zeros(n, bool)
        far = self.placed.select("leaf", "is_query", F.posexplode("far").alias("up", "r")) \
            .groupBy("leaf", "is_query", "up").agg(F.max("r").alias("r")).collect()                # bounded by the tree
        for r in far:
            node = self.tree.path(r["leaf"])[r["up"]]
            self.rd[node], self.has_d[node] = max(self.rd[node], r["r"]), True
            if r["is_query"]:
                self.rq[node], self.has_q[node] = max(self.rq[node], r["r"]), True

    def _blocks(self, rows: DataFrame, name: str) -> DataFrame:
        """Vectors packed into blocks of at most ``block_rows`` along the leaves: block, ids, leaves, matrix."""
        dim, size = self.dim, self.block_rows

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                order = np.argsort(np.asarray(b.column(0)), kind="stable")
                leaf, ids, v = np.asarray(b.column(0))[order], np.asarray(b.column(1))[order], _matrix(b.column(2), dim)[order]
                extra = [np.asarray(c)[order] for c in b.columns[3:]]
                cuts = range(0, len(ids), size)
                cols = [pa.array([x[i:i + size].astype(t).tobytes() for i in cuts], pa.binary())
                        for x, t in ((leaf, np.int32), (ids, np.int64), (v, np.int64), *((e, np.int64) for e in extra))]
                yield pa.RecordBatch.from_arrays(cols, names)
        names = [f"{name}_leaf", f"{name}_id", f"{name}_v"] + [f"{name}_bound"] * (len(rows.columns) > 3)
        packed = rows.mapInArrow(run, ", ".join(f"{c} binary" for c in names))
        return self.stored.put(packed.withColumn(f"{name}_block", F.monotonically_increasing_id()))

    def _meet(self, pairs: set[tuple[int, int]], q: DataFrame, d: DataFrame, with_bound: bool) -> DataFrame:
        """Scores of the leaf pairs: query, vector, score, at most k for each query and data block."""
        dim, k, spark = self.dim, self.k, self.placed.sparkSession
        by_q: dict[int, set[int]] = {}
        for a, b in pairs:
            by_q.setdefault(a, set()).add(b)

        def of(col: str) -> Column:
            @F.pandas_udf("array<int>")
            def leaves(raw: pd.Series) -> pd.Series:
                return raw.map(lambda b: np.unique(np.frombuffer(b, np.int32)))
            return leaves(col)

        table = spark.createDataFrame([(int(a), int(b)) for a, b in sorted(pairs)], "ql int, dl int")
        q_has = q.select("q_block", F.explode(of("q_leaf")).alias("ql"))
        d_has = d.select("d_block", F.explode(of("d_leaf")).alias("dl"))
        met = self.stored.put(q_has.join(table, "ql").join(d_has, "dl").select("q_block", "d_block").distinct())
        both = met.join(q.withColumnRenamed("q_block", "_q"), F.col("q_block") == F.col("_q")) \
            .join(d.withColumnRenamed("d_block", "_d"), F.col("d_block") == F.col("_d"))
        cols = ["q_leaf", "q_id", "q_v", "d_leaf", "d_id", "d_v"] + ["q_bound"] * with_bound

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for i in range(b.num_rows):
                    def get(j, kind, b=b, i=i):
                        return np.frombuffer(b.column(j)[i].as_py(), kind)
                    ql, qi, dl, di = get(0, np.int32), get(1, np.int64), get(3, np.int32), get(4, np.int64)
                    qv, dv = get(2, np.int64).reshape(len(qi), dim), get(5, np.int64).reshape(len(di), dim)
                    bound = get(6, np.int64) if with_bound else np.full(len(qi), LOWEST)
                    out = []
                    for leaf in np.unique(ql):
                        rows = np.flatnonzero(ql == leaf)
                        mates = np.flatnonzero(np.isin(dl, list(by_q.get(int(leaf), ()))))
                        if len(mates):
                            out.append(_top(qi[rows], di[mates], products(qv[rows], dv[mates]), bound[rows], k))
                    if out:
                        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["query", "id", "score"])
        return both.select(*cols).mapInArrow(run, "query long, id long, score long")

    def result(self) -> DataFrame:
        """``query_id, rank, vec_id, score``: the k best candidates of each query."""
        by = Window.partitionBy("query").orderBy(F.col("score").desc(), "id")
        empty = self.placed.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
        if not self.has_q.any():
            return empty
        rows = self.placed.where("is_query").groupBy("id").agg(F.min(F.struct("leaf", "v")).alias("x")) \
            .select(F.col("x.leaf").alias("leaf"), "id", F.col("x.v").alias("v"))
        d = self._blocks(self.placed.select("leaf", "id", "v").repartitionByRange("leaf", "id"), "d")
        q0 = self._blocks(rows.repartitionByRange("leaf", "id"), "q")

        # lower bounds: the own leaf and the nearest ones
        leaves_q = np.flatnonzero((self.tree.first < 0) & self.has_q)
        leaves_d = np.flatnonzero((self.tree.first < 0) & self.has_d)
        seed = set()
        for a in leaves_q:
            gap = np.linalg.norm(self.tree.centre[leaves_d] - self.tree.centre[a], axis=1)
            seed.update((int(a), int(leaves_d[j])) for j in np.argsort(gap, kind="stable")[:SEED_LEAVES])
        kth = self._meet(seed, q0, d, False).withColumn("n", F.row_number().over(by)).where(f"n = {self.k}") \
            .select(F.col("query").alias("_q"), "score")
        bounds = self.stored.put(rows.join(kth, F.col("id") == F.col("_q"), "left").select(
            "leaf", "id", "v", F.coalesce("score", F.lit(int(LOWEST)).cast("long")).alias("bound")))
        worst = np.full(len(self.tree.centre), np.inf)
        for r in bounds.groupBy("leaf").agg(F.min("bound").alias("m")).collect():                   # one row a leaf
            for node in self.tree.path(r["leaf"]):
                worst[node] = min(worst[node], -np.inf if r["m"] <= -LARGEST else float(r["m"]))

        pairs = set(walk(self.tree, self.rq, self.rd, worst, self.has_q, self.has_d))
        q = self._blocks(bounds.repartitionByRange("leaf", "id"), "q")
        best = self._meet(pairs, q, d, True)
        return best.withColumn("rank", F.row_number().over(by)).where(f"rank <= {self.k}") \
            .select(F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score")


def top_k(vectors: DataFrame, queries_where, k: int = 5, **options) -> DataFrame:
    """The ``k`` best scores of each query (rows for whose id ``queries_where`` holds)."""
    return TopK(vectors, queries_where, k, **options).result()


#: The same in DuckDB SQL (unique ids, vectors of one length).
ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, d.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, d.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id <> d.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 5
"""

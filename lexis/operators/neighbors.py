"""Exact k-nearest neighbours by a metric tree, without an all-pairs join.

1. A ball tree is fitted to a bounded sample of the training rows (``sample_rows``,
   chosen by a hash of the id below a cut-off that the row count gives).
2. Every training row descends to a leaf, the nearer centre at each fork; one pass
   without a shuffle measures each node's radius and row count over all rows.
3. The k-th nearest sample point bounds a query's k-th distance.  The queries of an
   Arrow batch that lie in one leaf form a group; the tree is walked for the whole
   group: a pair of group and node goes when their centres' distance less both radii
   exceeds the group's worst bound, at a leaf then query by query.
4. Training rows are shuffled once, to the buckets of their leaf (about
   ``bucket_rows`` each); a query goes to the buckets of the leaves that are left.  A
   bucket's rows come first in its sorted partition and are held, its queries stream
   past them: memory follows the bucket, not the number of queries.
5. The best k of each bucket meet in a second top-k for each query.

The result is exact: the triangle inequality only drops what can't be among the k.
How much it drops depends on the data (see PLANS.md): little in many dimensions
without clusters.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: relative slack of a bound against rounding
SLACK = 1e-9


def sq_dist(a, b) -> Column:
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))),
                       F.lit(0.0), lambda acc, v: acc + v)


def _dist(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """All distances between the rows of two matrices (rounded; for bounds, with SLACK)."""
    sq = (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T)
    return np.sqrt(np.maximum(sq, 0))


@dataclass
class BallTree:
    """Nodes in rows: centre, the two children (-1: a leaf), parent; leaves are numbered."""

    centre: np.ndarray
    left: np.ndarray
    right: np.ndarray
    leaf: np.ndarray                    # number of a leaf's node, -1 for a fork

    @property
    def n_leaves(self) -> int:
        return int(self.leaf.max()) + 1

    @classmethod
    def fit(cls, points: np.ndarray, n_leaves: int) -> BallTree:
        """The node with most points is split in two by a few rounds of 2-means that
        start from two far points, until there are ``n_leaves``."""
        centre, left, right = [points.mean(0)], [-1], [-1]
        heap = [(-len(points), 0, np.arange(len(points)))]
        count = 1
        while heap and count < n_leaves:
            _, node, rows = heapq.heappop(heap)
            x = points[rows]
            a = x[np.argmax(((x - centre[node]) ** 2).sum(1))]
            b = x[np.argmax(((x - a) ** 2).sum(1))]
            for _ in range(4):
                near = ((x - a) ** 2).sum(1) <= ((x - b) ** 2).sum(1)
                if near.all() or not near.any():
                    break
                a, b = x[near].mean(0), x[~near].mean(0)
            near = ((x - a) ** 2).sum(1) <= ((x - b) ** 2).sum(1)
            if near.all() or not near.any():
                continue                                   # equal points stay one leaf
            for part, side in ((near, left), (~near, right)):
                side[node] = len(centre)
                heapq.heappush(heap, (-int(part.sum()), len(centre), rows[part]))
                centre.append(x[part].mean(0))
                left.append(-1)
                right.append(-1)
            count += 1
        left, right = np.array(left), np.array(right)
        leaf = np.where(left < 0, np.cumsum(left < 0) - 1, -1)
        return cls(np.array(centre), left, right, leaf)

    def visit(self, x: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """``node, rows, distances`` for each node and the rows of ``x`` that descend through it."""
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if len(rows) == 0:
                continue
            d = np.sqrt(((x[rows] - self.centre[node]) ** 2).sum(1))
            yield node, rows, d
            if self.left[node] >= 0:
                two = [((x[rows] - self.centre[c]) ** 2).sum(1) for c in (self.left[node], self.right[node])]
                first = two[0] <= two[1]
                todo += [(int(self.left[node]), rows[first]), (int(self.right[node]), rows[~first])]

    def leaves(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(len(x), np.int64)
        for node, rows, _ in self.visit(x):
            if self.leaf[node] >= 0:
                out[rows] = self.leaf[node]
        return out


def _matrix(col: pa.Array) -> np.ndarray:
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(col), -1)


def _lists_of(x: np.ndarray) -> pa.ListArray:
    n, width = x.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(x.ravel()))


def _radii(tree: BallTree):
    """node, radius, n over the rows of a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        radius, n = np.zeros(len(tree.centre)), np.zeros(len(tree.centre), np.int64)
        for b in batches:
            if b.num_rows:
                for node, rows, d in tree.visit(_matrix(b.column(0))):
                    radius[node] = max(radius[node], d.max())
                    n[node] += len(rows)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(radius[some]), pa.array(n[some])], ["node", "radius", "n"])
    return run


@dataclass
class Index:
    """A fitted tree with what was measured over all training rows."""

    tree: BallTree
    sample: np.ndarray
    radius: np.ndarray
    rows: np.ndarray
    buckets: np.ndarray                 # number of buckets of each leaf

    def bounds(self, x: np.ndarray, k: int) -> np.ndarray:
        """For each query no less than the distance of its k-th nearest training row."""
        bound = np.full(len(x), np.inf)
        if len(self.sample) >= k:
            step = max(1, (1 << 20) // len(self.sample))
            for s in range(0, len(x), step):
                bound[s:s + step] = np.partition(_dist(x[s:s + step], self.sample), k - 1, axis=1)[:, k - 1]
        return bound * (1 + 1e-6) + 1e-6                   # above the rounding of _dist

    def route(self, x: np.ndarray, bound: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
        """For queries ``x`` and their bounds: ``queries, leaf``, the rows of one group that
        may have a neighbour in a leaf; pairs that are left are never held together."""
        tree = self.tree
        own = tree.leaves(x)
        for g in np.unique(own):
            rows = np.flatnonzero(own == g)
            centre = x[rows].mean(0)
            spread, worst = np.sqrt(((x[rows] - centre) ** 2).sum(1)).max(), bound[rows].max()
            todo = [0]
            while todo:
                node = todo.pop()
                if self.rows[node] == 0:
                    continue
                gap = np.sqrt(((centre - tree.centre[node]) ** 2).sum()) - spread - self.radius[node]
                if gap > worst * (1 + SLACK):
                    continue
                if tree.left[node] >= 0:
                    todo += [int(tree.left[node]), int(tree.right[node])]
                    continue
                d = np.sqrt(((x[rows] - tree.centre[node]) ** 2).sum(1))
                kept = rows[d - self.radius[node] <= bound[rows] * (1 + SLACK)]
                if len(kept):
                    yield kept, int(tree.leaf[node])


def fit_index(train: DataFrame, id_col: str, vec_col: str, n_leaves: int | None = None, sample_rows: int = 4096,
              bucket_rows: int = 4096, seed: int = 7, max_leaves: int = 1024) -> Index | None:
    """The tree over ``train``; None for an empty table.  ``n_leaves``: by default one for 512 rows, at most ``max_leaves``."""
    n = train.count()
    if n == 0:
        return None
    part = min(1.0, sample_rows / n)
    hashed = F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(1 << 30))
    picked = train.where(hashed < int(part * (1 << 30)) + 1).select(vec_col).limit(2 * sample_rows).toArrow()   # bounded
    sample = _matrix((picked if picked.num_rows else train.select(vec_col).limit(1).toArrow()).column(0).combine_chunks())
    tree = BallTree.fit(sample, n_leaves or max(1, min(max_leaves, n // 512, len(sample) // 4)))
    found = train.select(vec_col).mapInArrow(_radii(tree), "node int, radius double, n long") \
        .groupBy("node").agg(F.max("radius").alias("radius"), F.sum("n").alias("n")).toArrow()        # a row for each node
    radius, rows = np.zeros(len(tree.centre)), np.zeros(len(tree.centre), np.int64)
    at = found["node"].to_numpy()
    radius[at], rows[at] = found["radius"].to_numpy(), found["n"].to_numpy()
    per_leaf = rows[tree.leaf >= 0]
    return Index(tree, sample, radius * (1 + SLACK), rows, np.maximum(-(-per_leaf // bucket_rows), 1))


_BLOCK = "leaf int, bucket int, is_query int, id long, vec array<double>, bound double"


def _place(index: Index):
    """Training rows (id, vec) to their leaf's buckets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows == 0:
                continue
            x, ids = _matrix(b.column(1)), b.column(0).to_numpy(zero_copy_only=False)
            leaf = index.tree.leaves(x)
            with np.errstate(over="ignore"):
                salt = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
            bucket = salt.astype(np.int64) % index.buckets[leaf]
            yield pa.RecordBatch.from_arrays(
                [pa.array(leaf, pa.int32()), pa.array(bucket, pa.int32()), pa.array(np.zeros(len(x)), pa.int32()), b.column(0),
                 _lists_of(x), pa.array(np.zeros(len(x)))],
                ["leaf", "bucket", "is_query", "id", "vec", "bound"])
    return run


def _route(index: Index, k: int, step: int = 1 << 14):
    """Queries (id, vec) to the buckets of the leaves that may hold a neighbour."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows == 0:
                continue
            x = _matrix(b.column(1))
            bound = index.bounds(x, k)

            def out(parts):
                i, leaf, bucket = (np.concatenate(p) for p in zip(*parts))
                return pa.RecordBatch.from_arrays(
                    [pa.array(leaf, pa.int32()), pa.array(bucket, pa.int32()), pa.array(np.ones(len(i)), pa.int32()),
                     b.column(0).take(pa.array(i)), _lists_of(x[i]), pa.array(bound[i])],
                    ["leaf", "bucket", "is_query", "id", "vec", "bound"])
            parts, held = [], 0
            for rows, leaf in index.route(x, bound):
                for bucket in range(index.buckets[leaf]):
                    for s in range(0, len(rows), step):
                        i = rows[s:s + step]
                        parts, held = [*parts, (i, np.full(len(i), leaf), np.full(len(i), bucket))], held + len(i)
                        if held >= step:
                            yield out(parts)
                            parts, held = [], 0
            if parts:
                yield out(parts)
    return run


def _best(queries: np.ndarray, bound: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int, cells: int = 1 << 20) -> tuple:
    """(query row, id, distance) of the k nearest rows within the bound; ties to the smaller id."""
    out_q, out_n, out_d = [], [], []
    step = max(1, cells // max(1, len(x)))
    for s in range(0, len(queries), step):
        near = _dist(queries[s:s + step], x)
        slack = 1e-6 * (1 + near)
        kth = np.partition(near + slack, min(k, len(x)) - 1, axis=1)[:, min(k, len(x)) - 1]
        i, j = np.nonzero(near - slack <= np.minimum(kth, bound[s:s + step])[:, None])
        d = np.empty(len(i))
        for a in range(0, len(i), 1 << 16):                # many rows may be equally near
            diff = queries[s + i[a:a + (1 << 16)]] - x[j[a:a + (1 << 16)]]
            d[a:a + (1 << 16)] = np.sqrt(np.einsum("ij,ij->i", diff, diff))     # exact for those that are left
        order = np.lexsort((ids[j], d, i))
        i, j, d = i[order], j[order], d[order]
        first = np.searchsorted(i, i)                      # place of the query's first pair
        top = np.arange(len(i)) - first < k
        out_q.append(s + i[top])
        out_n.append(ids[j[top]])
        out_d.append(d[top])
    return np.concatenate(out_q), np.concatenate(out_n), np.concatenate(out_d)


def _meet(k: int):
    """Sorted blocks (leaf, bucket; training rows first): the block's rows are held, its queries stream past."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, ids, vecs, x = None, [], [], None
        for b in batches:
            if b.num_rows == 0:
                continue
            key = np.stack([b.column(i).to_numpy() for i in range(3)], 1).astype(np.int64)
            cuts = [0, *(np.flatnonzero((np.diff(key, axis=0) != 0).any(1)) + 1).tolist(), b.num_rows]
            for i, j in zip(cuts, cuts[1:]):
                part = b.slice(i, j - i)
                now = tuple(key[i, :2])
                if now != block:
                    block, ids, vecs, x = now, [], [], None
                if key[i, 2] == 0:
                    ids.append(part.column(3).to_numpy())
                    vecs.append(_matrix(part.column(4)))
                elif ids:
                    x = (np.concatenate(vecs), np.concatenate(ids)) if x is None else x
                    q, n, d = _best(_matrix(part.column(4)), part.column(5).to_numpy(), *x, k)
                    yield pa.RecordBatch.from_arrays([part.column(3).take(pa.array(q)), pa.array(n, pa.int64()), pa.array(d)], ["qid", "nid", "dist"])
    return run


def knn(train: DataFrame, test: DataFrame, id_col: str, vec_col: str, k: int = 2, n_leaves: int | None = None,
        sample_rows: int = 4096, bucket_rows: int = 4096, seed: int = 7) -> DataFrame:
    """(query_id, rank 0..k-1, neighbor_id, dist) for every test row; fewer ranks if there
    are fewer training rows.  Ids are whole numbers, vectors equally long; rows without
    an id, and vectors that are null or hold a null or non-finite number, take no part."""
    def rows(df):
        df = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
        return df.where(F.col("id").isNotNull() & F.forall("vec", lambda x: F.abs(x) <= 1e150))
    train, test = rows(train), rows(test)
    index = fit_index(train, "id", "vec", n_leaves, sample_rows, bucket_rows, seed)
    if index is None:
        return test.select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("neighbor_id"), F.lit(0.0).alias("dist")).limit(0)
    blocks = train.mapInArrow(_place(index), _BLOCK).union(test.mapInArrow(_route(index, k), _BLOCK))
    blocks = blocks.repartition("leaf", "bucket").sortWithinPartitions("leaf", "bucket", "is_query")
    got = blocks.mapInArrow(_meet(k), "qid long, nid long, dist double")
    w = Window.partitionBy("qid").orderBy("dist", "nid")   # at most k rows for each bucket a query went to
    return got.withColumn("rank", F.row_number().over(w) - 1).where(F.col("rank") < k) \
        .select(F.col("qid").alias("query_id"), "rank", F.col("nid").alias("neighbor_id"), "dist")


def routed_share(train: DataFrame, test: DataFrame, id_col: str, vec_col: str, k: int = 2, **options) -> DataFrame:
    """One row: queries, leaves, the (query, leaf) pairs that are left, and the share of
    all (query, training row) pairs that is evaluated."""
    index = fit_index(train, id_col, vec_col, **options)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        per_leaf = index.rows[index.tree.leaf >= 0]
        for b in batches:
            if b.num_rows:
                x, pairs, evaluated = _matrix(b.column(0)), 0, 0
                for rows, leaf in index.route(x, index.bounds(x, k)):
                    pairs, evaluated = pairs + len(rows), evaluated + len(rows) * int(per_leaf[leaf])
                yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([pairs]), pa.array([evaluated])], ["q", "p", "r"])
    got = test.select(F.col(vec_col).cast("array<double>")).mapInArrow(run, "q long, p long, r long")
    total = int(index.rows[0])
    return got.agg(F.sum("q").alias("queries"), F.lit(index.tree.n_leaves).alias("leaves"), F.sum("p").alias("pairs"),
                   (F.sum("r") / (F.sum("q") * total)).alias("evaluated_share"))


def knn_predict(neigh: DataFrame, train_labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """Majority vote of the neighbours; ties go to the smallest label."""
    j = neigh.join(train_labels.select(F.col(id_col).alias("neighbor_id"), F.col(label_col).alias("nl")), "neighbor_id")
    votes = j.groupBy("query_id", "nl").agg(F.count(F.lit(1)).alias("v"))
    best = votes.groupBy("query_id").agg(F.min_by("nl", F.struct(-F.col("v"), F.col("nl"))).alias("pred"))
    return best

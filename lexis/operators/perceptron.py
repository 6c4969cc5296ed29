"""Perceptron with one hidden layer on 0/1 features, trained on packed bits.

Spark ML's trainer keeps every row as dense doubles (48 KB a row at 6,144 inputs), which
no longer fits the executors' memory on larger tables.  Here a row is stored as its bits
(768 bytes); an evaluation of the loss is one job in which each task unpacks some rows at a
time, and the tasks' gradients, cut into parts, are summed by Spark.  The driver holds the
weights and the optimiser's last ten steps (their size depends on the layers alone).

The objective, the start and the optimiser are those of Spark ML: the mean over blocks of
``blockSize`` rows of a partition of their mean losses, random weights by ``seed``, L-BFGS
with ten corrections and a strong Wolfe search, ``maxIter`` and ``tol`` as there.  The
result is a Spark ML model.  Labels must be 0 .. outputs - 1 and features 0 or 1, as rows
without a label or with other values raise an error; repeated rows count as often as they
occur.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.classification import MultilayerPerceptronClassificationModel, MultilayerPerceptronClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexis.operators.linear import _lists
from lexis.session import store, unstore

#: rows that a task unpacks at a time
SLICE_ROWS = 64
#: parts that a gradient is cut into to be summed
PARTS = 8
CORRECTIONS = 10
#: losses that the last one is compared with
LAST_LOSSES = 20
_ROWS = "y int, share double, bits binary"


def _unpacked(vectors: pa.StructArray, n_in: int) -> np.ndarray:
    """Vectors (sparse or dense) of 0 and 1 as a boolean matrix."""
    (idx, _), (values, at) = _lists(vectors.field("indices")), _lists(vectors.field("values"))
    owner = np.repeat(np.arange(len(vectors)), np.diff(at))
    dense = (vectors.field("type").to_numpy(zero_copy_only=False) == 1)[owner]
    col = np.arange(len(values)) - at[owner]
    col[~dense] = idx
    if not ((values == 0) | (values == 1)).all():
        raise ValueError("features other than 0 and 1")
    x = np.zeros((len(vectors), n_in), bool)
    x[owner, col] = values == 1
    return x


def packed(rows: DataFrame, n_in: int, n_out: int, block_rows: int, label: str = "label", features: str = "features") -> DataFrame:
    """``y, share, bits`` of each row; ``share`` is one over the rows of its block (rows of a
    partition in their order, ``block_rows`` at a time)."""
    def block(ys, bits):
        n = len(ys)
        share = np.full(n, 1.0 / n)
        return pa.RecordBatch.from_arrays([pa.array(ys), pa.array(share), pa.array([r.tobytes() for r in bits], pa.binary())], ["y", "share", "bits"])

    def run(batches):
        ys, bits = np.zeros(0, np.int32), np.zeros((0, -(-n_in // 8)), np.uint8)
        for b in batches:
            if b.column("y").null_count or b.column("x").null_count:
                raise ValueError("a row without label or features")
            y = b.column("y").to_numpy()
            if not ((y >= 0) & (y < n_out) & (y == np.floor(y))).all():
                raise ValueError(f"labels must be 0 .. {n_out - 1}")
            for i in range(0, b.num_rows, 1000):
                ys = np.concatenate([ys, y[i:i + 1000].astype(np.int32)])
                bits = np.concatenate([bits, np.packbits(_unpacked(b.column("x").slice(i, 1000), n_in), axis=1)])
                while len(ys) >= block_rows:
                    yield block(ys[:block_rows], bits[:block_rows])
                    ys, bits = ys[block_rows:], bits[block_rows:]
        if len(ys):
            yield block(ys, bits)
    return rows.select(F.col(label).cast("double").alias("y"), F.col(features).alias("x")).mapInArrow(run, _ROWS)


def _layers(w: np.ndarray, sizes: tuple[int, int, int]) -> list[np.ndarray]:
    """Spark ML's weight vector as matrix and bias of both layers (views)."""
    n_in, hidden, n_out = sizes
    ends = np.cumsum([n_in * hidden, hidden, hidden * n_out, n_out])
    w1, b1, w2, b2 = np.split(w, ends[:-1])
    return [w1.reshape(n_in, hidden), b1, w2.reshape(hidden, n_out), b2]


def add_gradient(total: np.ndarray, w: np.ndarray, sizes: tuple[int, int, int], x: np.ndarray, y: np.ndarray, share: np.ndarray) -> float:
    """Adds the gradient of these rows, weighted by ``share``, to ``total``; their weighted loss."""
    (w1, b1, w2, b2), (g1, c1, g2, c2) = _layers(w, sizes), _layers(total, sizes)
    h = 1 / (1 + np.exp(-np.clip(x @ w1 + b1, -700, 700)))
    z = h @ w2 + b2
    z -= z.max(1, keepdims=True)
    e = np.exp(z)
    s = e.sum(1, keepdims=True)
    at = np.arange(len(y))
    loss = np.log(s[:, 0]) - z[at, y]
    d = e / s
    d[at, y] -= 1
    d *= share[:, None]
    g2 += h.T @ d
    c2 += d.sum(0)
    d = (d @ w2.T) * h * (1 - h)
    g1 += x.T @ d
    c1 += d.sum(0)
    return float(loss @ share)


def evaluate(data: DataFrame, w: np.ndarray, sizes: tuple[int, int, int], blocks: float) -> tuple[float, np.ndarray]:
    """Loss and gradient over rows as from ``packed``: one job."""
    width = -(-sizes[0] // 8)

    def run(batches):
        total, loss = np.zeros(len(w)), 0.0
        for b in batches:
            y, share = b.column("y").to_numpy(), b.column("share").to_numpy()
            bits = np.frombuffer(pa.concat_arrays([b.column("bits")]).buffers()[2], np.uint8)
            start = int(np.frombuffer(b.column("bits").buffers()[1], np.int32)[b.column("bits").offset])
            bits = bits[start:start + len(y) * width].reshape(len(y), width)
            for i in range(0, len(y), SLICE_ROWS):
                j = slice(i, i + SLICE_ROWS)
                x = np.unpackbits(bits[j], axis=1, count=sizes[0]).astype(np.float64)
                loss += add_gradient(total, w, sizes, x, y[j], share[j])
        parts = np.array_split(np.append(total, loss), PARTS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(PARTS, dtype=np.int32)), pa.array(np.full(PARTS, TaskContext.get().partitionId(), np.int32)),
                                          pa.array([p.tobytes() for p in parts], pa.binary())], ["part", "task", "g"])

    def add(t: pa.Table) -> pa.Table:
        t = t.sort_by("task")                            # the same sum whatever arrives first
        g = sum(np.frombuffer(x.as_py(), np.float64) for x in t["g"])
        return pa.table([t["part"][:1], pa.array([g.tobytes()], pa.binary())], ["part", "g"])
    got = data.mapInArrow(run, "part int, task int, g binary").groupBy("part").applyInArrow(add, "part int, g binary").collect()
    g = np.concatenate([np.frombuffer(r["g"], np.float64) for r in sorted(got, key=lambda r: r["part"])]) / blocks
    return float(g[-1]), g[:-1]


class SearchFailed(Exception):
    pass


def _cubic(a: tuple, b: tuple) -> float:
    """Step between two brackets (step, loss, slope), the first with the smaller step."""
    (s, f, d), (t, g, e) = a, b
    d1 = d + e - 3 * (f - g) / (s - t)
    d2 = np.sqrt(d1 * d1 - d * e) if d1 * d1 >= d * e else np.nan
    at = t - (t - s) * (e + d2 - d1) / (e - d + 2 * d2)
    low, high = s + 0.1 * (t - s), s + 0.9 * (t - s)
    return low if at < low else high if at > high else at


def wolfe_step(phi: Callable[[float], tuple], first: float, tries: int = 10) -> float:
    """Step that meets the strong Wolfe conditions; ``phi`` gives (step, loss, slope)."""
    start = low = phi(0.0)
    if start[2] > 0:
        raise SearchFailed("not a direction of descent")
    worse = lambda c: c[1] > start[1] + 1e-4 * c[0] * start[2]
    flat = lambda c: abs(c[2]) <= 0.9 * abs(start[2])

    def zoom(low, high):
        for _ in range(tries):
            c = phi(_cubic(*((high, low) if low[0] > high[0] else (low, high))))
            if worse(c) or c[1] >= low[1]:
                high = c
                continue
            if flat(c):
                return c[0]
            if c[2] * (high[0] - low[0]) >= 0:
                high = low
            low = c
        raise SearchFailed("zoom")
    t = first
    for i in range(tries):
        c = phi(t)
        if not np.isfinite(c[1]):
            t /= 2
            continue
        if worse(c) or (c[1] >= low[1] and i > 0):
            return zoom(low, c)
        if flat(c):
            return c[0]
        if c[2] >= 0:
            return zoom(c, low)
        low, t = c, t * 1.5
    raise SearchFailed("line")


def _direction(g: np.ndarray, past: list[tuple]) -> np.ndarray:
    """L-BFGS direction from the last steps and gradient changes, the latest first."""
    d, kept = g.copy(), []
    for s, y in past:
        kept.append((s @ d) / (s @ y))
        d -= kept[-1] * y
    if past:
        s, y = past[0]
        if not s @ y >= 0 or not np.isfinite(kept).all():
            raise SearchFailed("history")
        d *= (s @ y) / (y @ y)
    for (s, y), a in reversed(list(zip(past, kept))):
        d += (a - (y @ d) / (s @ y)) * s
    return -d


def minimise(f: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, max_iter: int, tol: float) -> tuple[np.ndarray, list[float]]:
    """L-BFGS: the last point and the loss of each step."""
    value, g = f(x)
    history, past, failed, steps = [value], [], False, 0
    seen = [np.inf]
    while steps < max_iter and np.linalg.norm(g) > max(tol * value, 1e-8) and not (
            len(seen) >= 2 and abs(value - max(seen)) <= tol * history[0]):
        known = {}

        def phi(t):
            known[t] = (value, g) if t == 0 else f(x + t * d)
            return t, known[t][0], float(known[t][1] @ d)
        try:
            d = _direction(g, past)
            t = wolfe_step(phi, 1.0 / np.linalg.norm(d) if steps == 0 else 1.0)
            if t * np.linalg.norm(g) < 1e-10:
                raise SearchFailed("step")
        except SearchFailed:
            if failed:
                break
            failed, past = True, []
            continue
        new, at = known[t]
        past = [(t * d, at - g), *past][:CORRECTIONS]
        x, value, g, failed, steps = x + t * d, new, at, False, steps + 1
        history.append(value)
        seen = [*seen, value][-LAST_LOSSES:]
    return x, history


def fit(est: MultilayerPerceptronClassifier, rows: DataFrame) -> MultilayerPerceptronClassificationModel:
    """Spark ML's model for this estimator, one hidden layer, on 0/1 features."""
    sizes = tuple(est.getLayers())
    if len(sizes) != 3:
        raise ValueError("one hidden layer is fitted")
    spark = rows.sparkSession
    # without iterations Spark ML makes the start from the seed, and a model from weights: the row it asks for has no effect
    one = spark.createDataFrame([(0.0, Vectors.sparse(sizes[0], {}))], ["label", "features"])
    whole = est.copy({est.maxIter: 0, est.labelCol: "label", est.featuresCol: "features"})
    data = store(packed(rows, sizes[0], sizes[2], est.getBlockSize(), est.getLabelCol(), est.getFeaturesCol()), "bits", "uncompressed")
    try:
        blocks = data.agg(F.sum("share")).first()[0]
        if not blocks:
            raise ValueError("no rows to train on")
        start = whole.fit(one).weights.toArray() if not est.isSet(est.initialWeights) else est.getInitialWeights().toArray()
        w, _ = minimise(lambda x: evaluate(data, x, sizes, blocks), start, est.getMaxIter(), est.getTol())
    finally:
        unstore(data)
    model = whole.copy({whole.initialWeights: Vectors.dense(w)}).fit(one)
    return model.copy({model.featuresCol: est.getFeaturesCol(), model.labelCol: est.getLabelCol()})

"""LM scoring: a hashed maximum-entropy model with a class-factored softmax.

Tokens are a text's words (A-Z in lower case) and one end.  The model gives

    P(token | context) = P(class | context) * P(token | class)

* P(class | context): softmax over ``CLASSES`` classes whose scores add hashed
  feature weights: the word before, the pair of words before (n-grams) and the
  word before that alone (skip).
* P(token | class): softmax with one feature, the token's count in the training
  documents (+ 0.5); the rarest class also holds one unknown token.  So the
  probabilities of all known tokens and the unknown one add up to 1.

Frequent words get their classes by k-means over the frequent words beside
which they stand; the other words form two classes by count, the end is one.

Training is a number of rounds over disjoint slices of the training documents.
In a round every task starts from the same weights, makes AdaGrad updates over
its documents in sparse numpy batches and returns what it changed; the changes
are averaged for each feature bucket by its use (summed in Spark, at most
``FEATURES * 2**BITS`` rows reach the driver).  Counts cover all training
documents.  The most frequent ``HEAD`` words travel to the tasks with their
counts; the counts of all others are joined by shuffle.

``base`` is the unigram score with add-0.5 smoothing.  Words are compared by
64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexis.llm.common import Stored, Words, mix64, word_slices

HEAD = 1 << 18
CLUSTERED = 1 << 16
ANCHORS = 32
CLASSES = 32
FEATURES = 3
BITS = 13
ROUNDS = 2
BATCH = 1 << 14
RATE = 0.25
END = np.uint64(0x5EED0FE4D00D5EED)
NONE = np.uint64(0x0123456789ABCDEF)          # stands before the first token


def held_out(doc_id: Column) -> Column:
    """Whether a document is held out of training: crc32(id as text) mod 5 is 1 (a null id is not)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 1, F.lit(False))


@dataclass
class Tokens:
    """The tokens of some documents: hash of each, hashes of the two before, first token of each document."""
    hash: np.ndarray
    before: np.ndarray
    before2: np.ndarray
    at: np.ndarray


def tokens(w: Words) -> Tokens:
    n, d = len(w.hash), w.n_docs
    h = np.empty(n + d, np.uint64)
    at = w.at + np.arange(d + 1)
    where = np.ones(n + d, bool)
    where[at[1:] - 1] = False
    h[where] = w.hash
    h[~where] = END
    before, before2 = np.empty_like(h), np.empty_like(h)
    before[1:], before2[2:] = h[:-1], h[:-2]
    first = at[:-1]
    before[first] = NONE
    before2[first] = NONE
    second = first + 1
    before2[second[second < len(h)]] = NONE          # the token after a first one (or the next text's first)
    return Tokens(h, before, before2, at)


class Lookup:
    """Index of a hash in an array of distinct hashes, -1 for others; numpy table without probing."""

    def __init__(self, keys: np.ndarray):
        self.shift = np.uint64(64 - max(4, (4 * max(len(keys), 1) - 1).bit_length()))
        size = 1 << (64 - int(self.shift))
        self.key, self.idx = np.zeros(size, np.uint64), np.full(size, -1, np.int32)
        slot = (keys >> self.shift).astype(np.int64)
        self.key[slot], self.idx[slot] = keys, np.arange(len(keys), dtype=np.int32)
        rest = np.flatnonzero(self.idx[slot] != np.arange(len(keys)))
        rest = rest[np.argsort(keys[rest])]
        self.more, self.more_idx = keys[rest], rest.astype(np.int32)
        self.full = np.zeros(size, bool)
        self.full[slot[rest]] = True

    def __call__(self, h: np.ndarray) -> np.ndarray:
        slot = (h >> self.shift).astype(np.int64)
        out = np.where(self.key[slot] == h, self.idx[slot], np.int32(-1))
        if len(self.more):
            again = np.flatnonzero((out < 0) & self.full[slot])
            if len(again):
                p = np.minimum(np.searchsorted(self.more, h[again]), len(self.more) - 1)
                out[again] = np.where(self.more[p] == h[again], self.more_idx[p], np.int32(-1))
        return out


@dataclass
class Model:
    """Everything a task needs; its size is bounded by HEAD, CLASSES and BITS."""
    words: np.ndarray                     # the head's hashes, most frequent first
    counts: np.ndarray
    classes: np.ndarray                   # class of each head word
    total: int                            # N
    distinct: int                         # V
    mass: np.ndarray                      # (count + 0.5) summed over each class
    weights: np.ndarray                   # FEATURES * 2**bits rows of CLASSES
    bias: np.ndarray
    bits: int = BITS
    lookup: Lookup = field(default=None, repr=False)

    @property
    def tail(self) -> int:
        return len(self.mass) - 1

    def buckets(self, t: Tokens) -> np.ndarray:
        """FEATURES rows of weight rows, one column for each token."""
        shift, size = np.uint64(64 - self.bits), 1 << self.bits
        with np.errstate(over="ignore"):
            pair = mix64(t.before * np.uint64(0x9E3779B97F4A7C15) + t.before2, 3)
        return np.stack([(mix64(x, s) >> shift).astype(np.int32) + i * size
                         for i, (x, s) in enumerate(((t.before, 1), (pair, 4), (t.before2, 2)))])

    def class_of(self, t: Tokens) -> tuple[np.ndarray, np.ndarray]:
        """Head index (-1: none) and class of each token."""
        if self.lookup is None:
            self.lookup = Lookup(self.words)
        head = self.lookup(t.hash)
        return head, np.where(head >= 0, self.classes[head] if len(self.classes) else self.tail, self.tail)

    def log_class(self, rows: np.ndarray) -> np.ndarray:
        """Log softmax of the classes for each column of ``rows``."""
        z = self.bias + self.weights[rows[0]]
        for r in rows[1:]:
            z += self.weights[r]
        z -= z.max(1, keepdims=True)
        z -= np.log(np.exp(z).sum(1, keepdims=True))
        return z


# ---------------------------------------------------------------- counts

def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """text -> t, c: token counts of a task."""
    keys, counts, held = [], [], 0

    def merged():
        k, c = np.concatenate(keys), np.concatenate(counts)
        u, inv = np.unique(k, return_inverse=True)
        return u, np.bincount(inv, weights=c, minlength=len(u)).astype(np.int64)
    for b in batches:
        for w in word_slices(b.column(0), lower=True):
            u, c = np.unique(tokens(w).hash, return_counts=True)
            keys.append(u)
            counts.append(c)
            held += len(u)
            if held > 3_000_000:
                u, c = merged()
                keys, counts, held = [u], [c], 0
                if len(u) > 1_500_000:                    # send on what is there: memory stays bounded
                    yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(c)], ["t", "c"])
                    keys, counts = [], []
    if keys:
        u, c = merged()
        for i in range(0, len(u), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(u[i:i + 100_000].view(np.int64)), pa.array(c[i:i + 100_000])], ["t", "c"])


def _beside(words: np.ndarray, anchors: int):
    """text -> cell (word * 2 * anchors + anchor), c: how often a clustered word
    stands behind (first half) or before (second half) a frequent word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look, total = Lookup(words), np.zeros(len(words) * 2 * anchors, np.int64)
        for b in batches:
            for w in word_slices(b.column(0), lower=True):
                t = tokens(w)
                i = look(t.hash)
                p = look(t.before)
                ok = np.flatnonzero((i >= 0) & (p >= 0) & (p < anchors))
                total += np.bincount(i[ok].astype(np.int64) * 2 * anchors + p[ok], minlength=len(total))
                ok = np.flatnonzero((p >= 0) & (i >= 0) & (i < anchors))
                total += np.bincount(p[ok].astype(np.int64) * 2 * anchors + anchors + i[ok], minlength=len(total))
        some = np.flatnonzero(total)
        for k in range(0, len(some), 200_000):
            yield pa.RecordBatch.from_arrays([pa.array(some[k:k + 200_000].astype(np.int32)), pa.array(total[some[k:k + 200_000]])], ["cell", "c"])
    return run


def cluster(x: np.ndarray, weight: np.ndarray, k: int, rounds: int = 15) -> np.ndarray:
    """Weighted k-means on the rows of x (unit length); starts from rows that are far from
    all earlier ones for their weight.  A cluster above twice its share of the weight gives
    its farthest rows to the lightest one before the last rounds.  Zero rows get cluster k."""
    some = np.flatnonzero(x.any(1))
    out = np.full(len(x), k, np.int64)
    if len(some) <= k:
        out[some] = np.arange(len(some))
        return out
    x, weight = x[some], weight[some]
    pull = np.sqrt(weight)
    centres = [x[int(np.argmax(weight))]]
    far = 1 - x @ centres[0]
    for _ in range(k - 1):
        centres.append(x[int(np.argmax(np.maximum(far, 0) * pull))])
        far = np.minimum(far, 1 - x @ centres[-1])
    c = np.array(centres)
    own = np.zeros(len(x), np.int64)
    for r in range(rounds):
        near = x @ c.T
        own = np.argmax(near, axis=1)
        s = np.zeros_like(c)
        np.add.at(s, own, x * pull[:, None])
        size = np.linalg.norm(s, axis=1, keepdims=True)
        c = np.where(size > 0, s / np.maximum(size, 1e-12), c)
        share = np.bincount(own, weights=pull, minlength=k)
        heavy, light = int(np.argmax(share)), int(np.argmin(share))
        if r < rounds - 3 and share[heavy] > 2 * share.sum() / k:
            rows = np.flatnonzero(own == heavy)
            c[light] = x[rows[int(np.argmax((1 - near[rows, heavy]) * pull[rows]))]]
    out[some] = own
    return out


# ---------------------------------------------------------------- training

def learn(model: Model, slices: Iterator[Words], rate: float, batch: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """AdaGrad over some texts from the model's weights: change of weights, use of each row, change of bias, tokens."""
    start, b0 = model.weights, model.bias
    work = Model(model.words, model.counts, model.classes, model.total, model.distinct, model.mass,
                 start.copy(), b0.copy(), model.bits, model.lookup)
    used = np.zeros(len(start), np.int64)
    grow, grow_b, n = np.ones(len(start), np.float32), 1.0, 0
    for w in slices:
        t = tokens(w)
        _, cls = work.class_of(t)
        rows = work.buckets(t)
        for lo in range(0, len(cls), batch):
            y, r = cls[lo:lo + batch], rows[:, lo:lo + batch]
            g = np.exp(work.log_class(r))
            g[np.arange(len(y)), y] -= 1.0
            for f in range(len(r)):
                order = np.argsort(r[f], kind="stable")
                u, first, c = np.unique(r[f][order], return_index=True, return_counts=True)
                s = np.add.reduceat(g[order], first, axis=0)
                grow[u] += (s * s).mean(1)
                work.weights[u] -= rate * s / np.sqrt(grow[u])[:, None]
                used[u] += c
            s = g.sum(0)
            grow_b += float((s * s).mean())
            work.bias -= np.float32(rate) * s / np.float32(np.sqrt(grow_b))
            n += len(y)
    model.lookup = work.lookup
    return work.weights - start, used, work.bias - b0, n


def _round(model: Model, rate: float, batch: int):
    """text -> row, n, d: what a task changed, times its use; row -1 is the bias."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        change, used, bias, n = learn(model, (w for b in batches for w in word_slices(b.column(0), lower=True)), rate, batch)
        u = np.flatnonzero(used)
        rows = np.concatenate([[-1], u])
        weight = np.concatenate([[n], used[u]])
        d = np.concatenate([bias[None], change[u]]) * weight[:, None]
        flat = pa.array(d.astype(np.float32).ravel())
        offs = pa.array(np.arange(len(rows) + 1) * d.shape[1], pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(rows.astype(np.int32)), pa.array(weight.astype(np.int64)),
                                          pa.ListArray.from_arrays(offs, flat)], ["row", "n", "d"])
    return run


def train(docs: DataFrame, head_size: int = HEAD, clustered: int = CLUSTERED, anchors: int = ANCHORS, classes: int = CLASSES,
          bits: int = BITS, rounds: int = ROUNDS, rate: float = RATE, batch: int = BATCH,
          stored: Stored | None = None) -> tuple[Model, DataFrame]:
    """Fit the model on all of ``docs`` (doc_id, text); also the table of all counts (t, c)."""
    stored = stored or Stored(docs.sparkSession, "lm")
    texts = docs.select("text")
    counts = stored.put(texts.mapInArrow(_count, "t long, c long").groupBy("t").agg(F.sum("c").alias("c")))
    total, distinct = counts.agg(F.sum("c"), F.count(F.lit(1))).first()
    total = int(total or 0)
    head = counts.orderBy(F.col("c").desc(), "t").limit(head_size).toArrow()           # at most head_size rows
    words, c = head["t"].to_numpy().astype(np.int64).view(np.uint64), head["c"].to_numpy().astype(np.int64)

    top = words[:clustered]
    anchors = min(anchors, len(top))
    x = np.zeros((len(top), 2 * anchors), np.float32)
    if total:
        cells = texts.mapInArrow(_beside(top, anchors), "cell int, c long").groupBy("cell").agg(F.sum("c").cast("float").alias("c"))
        for part in cells.toArrow().to_batches():                                          # at most clustered * 2 * anchors cells
            x.ravel()[part["cell"].to_numpy()] = np.sqrt(part["c"].to_numpy())
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    k = classes - 3
    own = np.full(len(words), k, np.int64)                                                # the rest of the head: one class
    own[:len(top)] = cluster(x, c[:len(top)].astype(np.float64), k)
    own[words == END] = k + 1
    mass = np.bincount(own, weights=c + 0.5, minlength=classes).astype(np.float64)
    mass[-1] = total + 0.5 * (distinct + 1) - mass[:-1].sum()                              # all other words and the unknown one
    with np.errstate(divide="ignore"):
        bias = np.log(np.maximum(mass, 1e-9) / mass.sum())
    model = Model(words, c, own.astype(np.int16), total, int(distinct), mass,
                  np.zeros((FEATURES << bits, classes), np.float32), bias.astype(np.float32), bits)
    for r in range(rounds if total else 0):
        part = docs.where(F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(rounds)) == r).select("text")
        got = part.mapInArrow(_round(model, rate, batch), "row int, n long, d array<float>").groupBy("row").agg(
            F.sum("n").alias("n"), F.array(*[F.sum(F.get("d", F.lit(i))) for i in range(classes)]).alias("d")).toArrow()
        if len(got):                                                                       # at most FEATURES * 2**bits + 1 rows
            row, n = got["row"].to_numpy(), got["n"].to_numpy()
            d = got["d"].combine_chunks().flatten().to_numpy().reshape(len(row), classes) / np.maximum(n, 1)[:, None]
            weights, b = model.weights.copy(), model.bias.copy()
            weights[row[row >= 0]] += d[row >= 0].astype(np.float32)
            b += d[row < 0].sum(0).astype(np.float32)
            model.weights, model.bias = weights, b
    model.lookup = None
    return model, counts


# ---------------------------------------------------------------- scoring

def score_slice(model: Model, w: Words, batch: int = BATCH):
    """For each text: tokens, known and log10 base score of its head tokens, gain
    of the model over the base in log10, and the other tokens with their numbers."""
    t = tokens(w)
    head, cls = model.class_of(t)
    rows = model.buckets(t)
    with np.errstate(divide="ignore"):
        usual = np.log(model.mass / model.mass.sum())
    gain = np.empty(len(cls))
    for lo in range(0, len(cls), batch):
        y = cls[lo:lo + batch]
        gain[lo:lo + batch] = model.log_class(rows[:, lo:lo + batch])[np.arange(len(y)), y] - usual[y]
    z = np.log10(model.total + 0.5 * (model.distinct + 1))
    known = head >= 0
    base = np.where(known, np.log10((model.counts[head] if len(model.counts) else np.zeros(len(head))) + 0.5) - z, 0.0)
    sums = [np.add.reduceat(v, t.at[:-1]) for v in (known.astype(np.int64), base, gain)] if w.n_docs else [np.zeros(0)] * 3
    others = []
    for d in range(w.n_docs):
        i, j = t.at[d], t.at[d + 1]
        others.append(np.unique(t.hash[i:j][~known[i:j]], return_counts=True))
    return np.diff(t.at), sums[0], sums[1], sums[2] / np.log(10), others


def _score(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = [[], [], [], []]
            ts, ns = [], []
            for w in word_slices(b.column(2), lower=True):
                *got, others = score_slice(model, w)
                for c, g in zip(cols, got):
                    c.append(g)
                ts += [u.view(np.int64) for u, _ in others]
                ns += [c.astype(np.int32) for _, c in others]
            kinds = [np.int64, np.int64, np.float64, np.float64]
            out = [pa.array(np.concatenate(c).astype(k) if c else np.zeros(0, k)) for c, k in zip(cols, kinds)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), *out, pa.array(ts, pa.list_(pa.int64())), pa.array(ns, pa.list_(pa.int32()))],
                ["doc_id", "held_out", "n_tokens", "head_known", "head_base", "gain", "ts", "ns"])
    return run


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Return ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``
    for every row, after training on the rows that are not held out.

    Null and empty texts have one token, the end.  A null id is a training row;
    rows with the same id are rows of their own.  Without training rows every
    token is the unknown one, with probability 1.  An empty table gives an
    empty result; other columns are ignored."""
    stored = Stored(docs.sparkSession, "lm")
    id_type = docs.schema[id_col].dataType.simpleString()
    src = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text"))
    model, counts = train(src.where("NOT held_out").select("doc_id", "text"), stored=stored, **options)
    one = src.mapInArrow(_score(model), f"doc_id {id_type}, held_out boolean, n_tokens long, head_known long, "
                                        "head_base double, gain double, ts array<long>, ns array<int>")
    one = stored.put(one.withColumn("rid", F.monotonically_increasing_id()))              # unique once written
    z = float(np.log10(model.total + 0.5 * (model.distinct + 1)))
    rest = one.select("rid", F.explode(F.arrays_zip("ts", "ns")).alias("x")).select("rid", F.col("x.ts").alias("t"), F.col("x.ns").alias("n"))
    rare = counts.select(F.col("t").alias("_t"), "c")
    rest = rest.join(rare, F.col("t") == F.col("_t"), "left").groupBy("rid").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("more_known"),
        F.sum(F.col("n") * (F.log10(F.coalesce("c", F.lit(0)) + 0.5) - z)).alias("more_base")).withColumnRenamed("rid", "_rid")
    out = one.drop("ts", "ns").join(rest, F.col("rid") == F.col("_rid"), "left")
    base = F.col("head_base") + F.coalesce("more_base", F.lit(0.0))
    return out.select("doc_id", "held_out", "n_tokens", (F.col("head_known") + F.coalesce("more_known", F.lit(0))).cast("long").alias("n_known"),
                      F.lit(model.total).cast("long").alias("train_tokens"), base.alias("base_score"), (base + F.col("gain")).alias("score"))

"""The language model against plain counts, its own normalisation and held-out text."""

import math
import os
import re
import sys
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from conftest import SF001, SF01  # noqa: E402

from lexis.llm import hashed_maxent as lm  # noqa: E402
from lexis.llm.common import word_slices  # noqa: E402
from lexis.llm.queries import queries  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows):
    toks = [WORD.findall((t or "").translate(LOWER)) + [None] for _, t in rows]
    held = [d is not None and zlib.crc32(str(d).encode()) % 5 == 1 for d, _ in rows]
    c = Counter(x for t, h in zip(toks, held) if not h for x in t)
    n, v = sum(c.values()), len(c)
    return sorted(((d, h, len(t), sum(c[x] > 0 for x in t), n, sum(math.log10((c[x] + .5) / (n + .5 * (v + 1))) for x in t))
                   for (d, _), t, h in zip(rows, toks, held)), key=str)


def same(got, rows):
    got = sorted((tuple(r) for r in got), key=lambda r: str(r[:5]))
    want = sorted(brute(rows), key=lambda r: str(r[:5]))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    key = lambda r: (str(r[:5]), round(r[5], 3))
    for g, w in zip(sorted(got, key=key), sorted(want, key=key)):
        assert abs(g[5] - w[5]) <= 1e-9 * max(1, abs(w[5])) + 1e-6
        assert math.isfinite(g[6]) and g[6] <= 1e-6


ROWS = [(i, " ".join(f"{'ab'[i % 2]}{(i * j) % 17}" for j in range(i % 60))) for i in range(200)]
ROWS += [(300, None), (301, ""), (302, " \n"), (None, "null id"), (7, ROWS[7][1]), (7, "Other Text"), (303, "É é A a"),
         (304, "w " * 30000), (305, " ".join(f"u{i}" for i in range(5000))), (306, "end")]


def test_counts_and_base(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string").selectExpr("*", "1 AS rid", "2 AS t", "3 AS held_out")
    for opt in ({}, {"head_size": 10, "clustered": 5, "classes": 6, "batch": 64}):
        same(lm.lm_scores(df.repartition(4), **opt).collect(), ROWS)
    assert lm.lm_scores(df.limit(0)).count() == 0
    only_held = [(d, t) for d, t in ROWS if d is not None and zlib.crc32(str(d).encode()) % 5 == 1]
    got = lm.lm_scores(spark.createDataFrame(only_held, "doc_id long, text string")).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0 and abs(r.score) < 1e-6 for r in got)


def test_probabilities_add_up_to_one(spark):
    """Over all known words, the end and the unknown word, in several contexts."""
    rows = [(i, t) for i, t in ROWS if t]
    df = spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", "text")
    model, counts = lm.train(df, head_size=40, clustered=20, classes=8, batch=128)
    known = sorted({x for _, t in rows for x in WORD.findall(t.translate(LOWER))})
    c = Counter(x for _, t in rows for x in WORD.findall(t.translate(LOWER)))
    c[None] = len(rows)
    z = model.total + .5 * (model.distinct + 1)
    assert model.total == sum(c.values()) and model.distinct == len(c)
    for context in ("", "a1", "b2 a1", "never seen"):
        texts = [f"{context} {x}" for x in known] + [f"{context} unknownword", context]
        total = 0.0
        for w in word_slices(pa.array(texts)):
            t = lm.tokens(w)
            head, cls = model.class_of(t)
            logp = model.log_class(model.buckets(t))
            k = len(context.split())
            for d, x in enumerate([*known, "unknownword", None]):
                i = t.at[d] + k
                total += math.exp(logp[i, cls[i]]) * (c[x] + .5) / model.mass[cls[i]]
        assert abs(total - 1) < 1e-4
    assert abs(model.mass.sum() - z) < 1e-6


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    same(queries()["op9_hashed_maxent"](spark, SF001).collect(), rows)


def test_better_than_unigrams_on_held_out_text(spark):
    got = [r for r in queries()["op9_hashed_maxent"](spark, SF01).collect() if r.held_out]
    n = sum(r.n_tokens for r in got)
    base, score = (-sum(getattr(r, k) for r in got) / n / math.log10(2) for k in ("base_score", "score"))
    print("bits a token", base, score)
    assert score < base - 0.3


def test_lookup():
    rnd = np.random.default_rng(1)
    keys = np.unique(rnd.integers(0, 1 << 63, 5000, dtype=np.uint64))
    rnd.shuffle(keys)
    look = lm.Lookup(keys)
    assert (look(keys) == np.arange(len(keys))).all() and (look(keys + np.uint64(1)) == -1).mean() > .99
    assert (lm.Lookup(keys[:0])(keys) == -1).all()

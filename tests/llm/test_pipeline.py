"""The pipeline against brute-force versions of its stages."""

import hashlib
import math
import os
import sys
from collections import Counter, defaultdict

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from conftest import SF001  # noqa: E402

sentencepiece = pytest.importorskip("sentencepiece")

import corpus_pipeline  # noqa: E402
from lexis.llm import common, quality_llr, source_mix as sm  # noqa: E402
from lexis.llm.queries import tokenizer  # noqa: E402
from test_near_stage import groups  # noqa: E402
import test_quality_and_mix as tq  # noqa: E402
from test_dedup import WORD  # noqa: E402


def cut_lines(rows):
    """rows: dicts; texts without later three-line windows."""
    first, parts = {}, []
    for r in rows:
        lines = (r["text"] or "").split("\n")
        counted = [i for i, x in enumerate(lines) if WORD.search(x)]
        parts.append((lines, counted))
        for p in range(len(counted) - 2):
            k = tuple(lines[i] for i in counted[p:p + 3])
            first[k] = min(first.get(k, (r["doc_id"], p)), (r["doc_id"], p))
    for r, (lines, counted) in zip(rows, parts):
        gone = set()
        for p in range(len(counted) - 2):
            if first[tuple(lines[i] for i in counted[p:p + 3])] < (r["doc_id"], p):
                gone.update(counted[p:p + 3])
        if gone:
            text = "\n".join(x for i, x in enumerate(lines) if i not in gone)
            r.update(text=text, n_chars=len(text))
    return rows


def permuted(x, n, *key):
    for r in range(sm.ROUNDS):
        other = (tq.spark_hash(*key, i32(r)) % n - x) % n
        if tq.spark_hash(*key, i32(r), max(x, other), n) % 2:
            x = other
    return x


class i32(int):
    """An integer that the engine hashes as four bytes."""


def spark_hash(*values):
    import xxhash
    h = 42
    for v in values:
        size = 4 if isinstance(v, i32) else 8
        h = xxhash.xxh64_intdigest((v & ((1 << 8 * size) - 1)).to_bytes(size, "little"), seed=h)
    return tq.signed(h)


def mix(rows, monkeypatch):
    """An independent version of the mix: documents' new texts."""
    monkeypatch.setattr(tq, "spark_hash", spark_hash)
    by = defaultdict(list)
    for r in rows:
        by[r["source"]].append((r["doc_id"], WORD.findall(r["text"] or ""), r))
    sizes = {s: sum(len(w) for _, w, _ in d) for s, d in by.items()}
    target = tq.targets(sizes)
    out, b = {}, sm.BLOCK_WORDS
    for rank, s in enumerate(sorted(by, key=lambda s: (s is None, (s or "").encode()))):
        if not sizes[s]:
            continue
        n = math.ceil(sizes[s] / b)
        k_all = min(2 * n, math.floor(target[s] * n / sizes[s] + .5))
        times = Counter(permuted(k % n, n, i32(sm.SEED), rank, k // n) for k in range(k_all))
        at = 0
        for d, w, r in sorted(by[s], key=lambda x: x[0]):
            per = [times[(at + i) // b] for i in range(len(w))]
            at += len(w)
            if w and max(per):
                if min(per) == max(per):
                    text = "\n".join([r["text"]] * per[0])
                else:
                    one = " ".join(x for x, t in zip(w, per) if t >= 1)
                    two = " ".join(x for x, t in zip(w, per) if t >= 2)
                    text = one + ("\n" + two if max(per) > 1 else "")
                out[d] = text
    return out


def test_pipeline_equals_brute_force(spark, monkeypatch):
    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    rows = [r.asDict() for r in docs.collect()]
    trusted = {r.doc_id for r in spark.read.parquet(f"{SF001}/labels.parquet").collect() if r.quality == 1 and r.toxic == 0}
    good = {r[0] for r in tq.brute([(r["doc_id"], r["text"]) for r in rows], trusted, quality_llr.BUCKETS) if r[7]}
    rows = [r for r in rows if r["doc_id"] in good]
    stored = common.Stored(spark, "test")

    def step(name):
        got = stored.put(stages[name](spark, step.docs, SF001))
        assert got.columns == docs.columns
        step.docs = got
        return sorted(map(tuple, got.collect()))
    step.docs = docs
    key = docs.columns
    assert step("quality_rules") == sorted(tuple(r[c] for c in key) for r in rows)
    rows = cut_lines(rows)
    assert step("line_dedup") == sorted(tuple(r[c] for c in key) for r in rows)
    rows = sorted(rows, key=lambda r: r["doc_id"])
    sets, root = groups([r["text"] for r in rows])
    rows = [r for i, r in enumerate(rows) if not sets[i] or root[i] == i]
    assert step("near_duplicates") == sorted(tuple(r[c] for c in key) for r in rows)
    new = mix(rows, monkeypatch)
    rows = [r | {"text": new[r["doc_id"]], "n_chars": len(new[r["doc_id"]])} for r in rows if r["doc_id"] in new]
    assert step("source_mixing") == sorted(tuple(r[c] for c in key) for r in rows)
    m = sentencepiece.SentencePieceProcessor(model_file=tokenizer("piece_bpe_32k.model"))
    want = []
    for r in rows:
        ids = m.encode(r["text"])
        want.append((r["doc_id"], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(m.decode(ids).encode()).hexdigest()))
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF001).collect())) == sorted(want)


def test_stages_on_odd_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, _row int, kept string, key long"
    long = " ".join(f"w{i % 977}x{i}" for i in range(30000))
    rows = [(1, None, None, None, None, 1, "a", 2), (None, None, None, None, None, None, None, None), (2, "", "en", "", 0, 1, "a", 2),
            (3, long, "en", "s", len(long), 1, "a", 2), (3, long, "en", "s", len(long), 1, "a", 2), (4, long + " end", "en", None, 1, 1, "a", 2),
            (None, "one two three four five six seven eight nine ten eleven", "en", "s", 3, 1, "a", 2)]
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        stored = common.Stored(spark, "test")
        for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
            got = stored.put(stage(spark, docs, SF001))
            if i < len(corpus_pipeline.STAGES) - 1:
                assert got.columns == docs.columns
                docs = got
            got.collect()

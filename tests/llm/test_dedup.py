"""Line dedup and substring dedup against plain loops."""

import hashlib
import os
import random
import re
import sys
from collections import defaultdict

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from conftest import SF001  # noqa: E402

from lexis.llm import line_windows as lw  # noqa: E402
from lexis.llm import window_doubling as wd  # noqa: E402
from lexis.llm.queries import oracles, queries  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def brute_words(rows, window):
    first = {}
    for d, t in rows:
        w = WORD.findall(t or "")
        for i in range(len(w) - window + 1):
            if d is not None:
                k = tuple(w[i:i + window])
                first[k] = min(first.get(k, d), d)
    out = []
    for d, t in rows:
        w = WORD.findall(t or "")
        gone = set()
        for i in range(len(w) - window + 1):
            if d is not None and first[tuple(w[i:i + window])] < d:
                gone.update(range(i, i + window))
        out.append((d, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return sorted(out, key=str)


def brute_lines(rows):
    first = {}
    split = []
    for d, t in rows:
        lines = (t or "").split("\n")
        counted = [i for i, x in enumerate(lines) if WORD.search(x)]
        split.append((lines, counted))
        if d is not None:
            for p in range(len(counted) - 2):
                k = tuple(lines[i] for i in counted[p:p + 3])
                first[k] = min(first.get(k, (d, p)), (d, p))
    out = []
    for (d, t), (lines, counted) in zip(rows, split):
        gone = set()
        if d is not None:
            for p in range(len(counted) - 2):
                if first[tuple(lines[i] for i in counted[p:p + 3])] < (d, p):
                    gone.update(counted[p:p + 3])
        out.append((d, len(counted), len(gone), sha("\n".join(x for i, x in enumerate(lines) if i not in gone))))
    return sorted(out, key=str)


def corpus(seed, sep):
    rnd = random.Random(seed)
    pool = [sep.join(rnd.choice("abcdefg") + str(rnd.randint(0, 9)) for _ in range(rnd.randint(3, 30))) for _ in range(25)]
    rows = []
    for d in range(120):
        parts = [rnd.choice(pool) if rnd.random() < .4 else sep.join(rnd.choice("vwxyz") + str(rnd.randint(0, 99)) for _ in range(rnd.randint(0, 12)))
                 for _ in range(rnd.randint(0, 5))]
        rows.append((d, sep.join(parts)))
    rows += [(200, None), (201, ""), (202, sep.join(["r"] * 300)), (203, sep.join(["r"] * 200)), (None, rows[3][1]), (None, rows[3][1]),
             (5, rows[5][1]), (5, rows[5][1]), (204, rows[5][1]), (205, rows[5][1]), (206, " \n\t " + rows[8][1]),
             (207, sep.join(f"u{i}" for i in range(30000))), (208, "é漢" + sep + "½" + sep + "x y")]
    rnd.shuffle(rows)
    return rows


def test_repeated_windows(spark):
    for seed, window in ((1, 6), (2, 7), (3, 20), (4, 2)):
        rows = corpus(seed, " ")
        df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS key", "2 AS n_words", "3 AS at")
        got = wd.remove_repeats(df.repartition(5), window=window, with_text=True).collect()
        assert sorted((tuple(r)[:4] for r in got), key=str) == brute_words(rows, window)
        assert all(r.kept is None or sha(r.kept) == r.kept_sha256 for r in got)
        assert any(r.kept for r in got)
    assert wd.remove_repeats(df.limit(0)).count() == 0


def test_levels_double_and_prune(spark, monkeypatch):
    """A window of 200 words takes five levels; shorter repeats are dropped on the way."""
    assert wd.lengths(50) == [13, 25, 50] and wd.lengths(200) == [13, 25, 50, 100, 200] and wd.lengths(2) == [1, 2]
    word = iter(range(10 ** 6))

    def fresh(n):
        return [f"w{next(word)}" for _ in range(n)]
    long, medium, short = fresh(230), fresh(120), fresh(30)
    rows = [(i, " ".join(fresh(20) + long + fresh(7) + medium + fresh(90) + short + fresh(i))) for i in range(4)]
    rows += [(9, " ".join(medium + fresh(100))), (10, " ".join(short + fresh(200))), (11, " ".join(long[:199] + fresh(50))), (12, " ".join(fresh(300)))]
    seen, real = [], wd.Stored.put

    def put(self, df):
        out = real(self, df)
        if "at" in df.columns and "a" in df.columns:
            seen.append((len([c for c in df.columns if c.startswith("g")]), out.count(), out.select("doc_id").distinct().count()))
        return out
    monkeypatch.setattr(wd.Stored, "put", put)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r)[:4] for r in wd.remove_repeats(df.repartition(3), window=200).collect()), key=str)
    assert got == brute_words(rows, 200)
    assert sorted(r[2] for r in got) == [0] * 5 + [230] * 3
    assert [s[0] for s in seen] == [3, 2, 1, 0]                         # names left after each level
    assert all(x[1] >= y[1] for x, y in zip(seen, seen[1:])) and seen[0][1] > seen[-1][1] and seen[0][2] > seen[-1][2]


def test_repeated_windows_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    got = sorted(map(tuple, queries()["op10_window_doubling"](spark, SF001).collect()), key=str)
    assert got == brute_words(rows, 50)


def test_lines(spark):
    for seed in (1, 2):
        rows = corpus(seed, "\n")
        df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS key", "2 AS at", "7L AS n_chars", "0 AS _d")
        got = sorted(map(tuple, lw.line_digests(df).collect()), key=str)
        assert got == brute_lines(rows)
        new = lw.dedup_lines(df)
        assert new.columns == df.columns and new.count() == len(rows)
        want = defaultdict(list)
        for d, _, n, s in brute_lines(rows):
            want[d].append((n, s))
        for r in new.collect():
            assert any(sha(r.text or "") == s and r.n_chars == (len(r.text) if n else 7) for n, s in want[r.doc_id])
    assert lw.line_digests(df.limit(0)).count() == 0


def test_lines_query(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF001}/documents.parquet')")
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    got = sorted(map(tuple, queries()["op5_line_windows"](spark, SF001).collect()), key=str)
    assert got == brute_lines(rows) == sorted(con.execute(oracles()["op5_line_windows"]).fetchall(), key=str)


def test_sliding():
    import numpy as np
    x = np.random.default_rng(1).integers(0, 50, 100)
    for w in (1, 2, 3, 26, 100):
        assert list(wd.sliding(x, w, np.minimum)) == [x[i:i + w].min() for i in range(101 - w)]

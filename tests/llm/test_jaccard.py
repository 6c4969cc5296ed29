"""N-gram Jaccard join against all pairs on small tables."""

import os
import random
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from conftest import SF001, SF01  # noqa: E402

from lexis.llm import shingle_join as sj  # noqa: E402
from lexis.llm.queries import queries  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(t):
    w = WORD.findall((t or "").translate(LOWER))
    return {tuple(w[i:i + 3]) for i in range(len(w) - 2)} or ({tuple(w)} if w else set())


def brute(rows, percent=90):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 10 * min(len(a), len(b)) >= 9 * max(len(a), len(b)):
                k = len(a & b)
                if 100 * k >= percent * (len(a) + len(b) - k):
                    x, y = find(i), find(j)
                    root[max(x, y)] = min(x, y)
    least = {}
    for i, (d, _) in enumerate(rows):
        if sets[i] and d is not None:
            r = find(i)
            least[r] = min(least.get(r, d), d)
    out = []
    for i, (d, _) in enumerate(rows):
        out.append((d, len(sets[i]), least.get(find(i)) if sets[i] else d))
    return sorted(out, key=str), [find(i) for i in range(len(rows))], sets


def corpus(seed):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    passage = [rnd.choice(vocab) for _ in range(12)]
    rows = []
    for d in range(60):
        rows.append((d, " ".join(rnd.choice(vocab) for _ in range(rnd.randint(1, 120)))))
    base = [rnd.choice(vocab) for _ in range(150)]
    for d in range(60, 160):          # near copies, few and many changes; chains between them
        w = list(base)
        for _ in range(rnd.randint(0, 6)):
            w[rnd.randrange(len(w))] = f"x{rnd.randint(0, 99)}"
        rows.append((d, " ".join(w)))
    step = list(base[:100])
    for d in range(160, 200):         # a long chain: neighbours link, ends don't
        step[(d * 7) % 100] = f"c{d}"
        rows.append((d, " ".join(step)))
    for d in range(200, 240):         # a common passage in short texts
        rows.append((d, " ".join(passage + [rnd.choice(vocab) for _ in range(rnd.randint(0, 6))])))
    rows += [(300, None), (301, ""), (302, " \n"), (303, "A b"), (304, "a B"), (305, "a"), (306, "é É"), (None, rows[70][1]),
             (7, rows[7][1]), (7, "other text with id seven"), (308, rows[3][1].upper()), (309, rows[3][1].replace(" ", "\n")),
             (310, "z " * 3000), (311, "z " * 4000), (312, " ".join(f"q{i}" for i in range(20000))),
             (313, " ".join(f"q{i}" for i in range(19500))), (None, "only null"), (None, "only null")]
    rnd.shuffle(rows)
    return rows


def test_groups(spark):
    for seed in (1, 2):
        rows = corpus(seed)
        df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS cid", "2 AS n", "3 AS _d")
        want, _, _ = brute(rows)
        got = sorted(map(tuple, sj.jaccard_groups(df.repartition(6), bits=8).collect()), key=str)
        assert got == want
    assert sj.jaccard_groups(df.limit(0)).count() == 0


def test_other_thresholds(spark):
    rows = corpus(5)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for percent in (95, 100):
        assert sorted(map(tuple, sj.jaccard_groups(df, percent=percent, bits=4).collect()), key=str) == brute(rows, percent)[0]


def test_one_of_each_group_stays(spark):
    rows = corpus(3)
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'s' AS source", "1 AS _row", "2 AS key")
    _, root, sets = brute(rows)
    got = sj.keep_one_of_each(df, bits=8)
    assert got.columns == df.columns
    kept = Counter((r.doc_id, r.text) for r in got.collect())
    groups = {}
    for i, (d, t) in enumerate(rows):
        groups.setdefault(root[i] if sets[i] else ("empty", i), []).append((d, t))
    for k, members in groups.items():
        n = sum(min(kept[m], 1) for m in set(members))
        assert n == 1, members
        best = min(members, key=lambda m: (m[0] is None, m[0] or 0))
        assert any(kept[m] for m in members if m[0] == best[0])
    assert sum(kept.values()) == len(groups)


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    assert sorted(map(tuple, queries()["op7_shingle_join"](spark, SF001).collect()), key=str) == brute(rows)[0]


def test_query_larger(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()]
    assert sorted(map(tuple, queries()["op7_shingle_join"](spark, SF01).collect()), key=str) == brute(rows)[0]

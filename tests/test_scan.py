"""Segmented scans against plain loops, whatever the partitions and segments."""

import random

import numpy as np
import pytest

from lexis.operators import scan as S


def rows_of(seed, n=900):
    rnd = random.Random(seed)
    hot = [(7, i, rnd.choice([0, 1, 5, 50, 300, 700, 1100])) for i in range(n)]         # most rows: one group
    small = [(g, i * 2, rnd.choice([0, 30, 900, 1025])) for g in [None, *range(20, 60)] for i in range(rnd.randint(1, 5))]
    return hot + small


def loop_pack(rows, budget):
    out, now = {}, object()
    for g, i, s in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        if g != now:
            now, fill, pos, b = g, 0, 0, 0
        if fill + s <= budget:
            fill += s
        else:
            fill, b = s, b + 1
        out[g, i] = (pos, b)
        pos += 1
    return out


@pytest.mark.parametrize("parts,segment,fan", [(1, 1 << 20, 64), (5, 3, 64), (40, 7, 3), (40, 1 << 20, 2)])
def test_packing_equals_a_loop(spark, monkeypatch, parts, segment, fan):
    """``fan`` 2 and 3 compose the partitions' summaries over several levels."""
    monkeypatch.setattr(S, "FAN", fan)
    rows = rows_of(parts)
    df = spark.createDataFrame(rows, "g long, i long, s long")
    got = S.segmented_scan(df, "g", ["i"], S.Packing("s", 1024), n_parts=parts, segment_rows=segment).collect()
    assert {(r.g, r.i): (r.pos, r.bin) for r in got} == loop_pack(rows, 1024)
    last = {}
    for g, i, _ in rows:
        last[g] = max(last.get(g, -1), i)
    assert sorted((str(r.g), r.i) for r in got if r.ends) == sorted((str(g), i) for g, i in last.items())


def test_summaries_compose(spark):
    """A summary of two stretches is that of both, for every entry fill."""
    rnd = random.Random(3)
    for budget in (1, 4, 60):
        p = S.Packing("s", budget)
        for _ in range(40):
            a, b = (np.array([rnd.choice([0, 1, 2, 3, budget, budget + 1]) for _ in range(rnd.randint(1, 12))]) for _ in "ab")
            both, joined = p.summarise([np.concatenate([a, b])]), p.combine(p.summarise([a]), p.summarise([b]))
            assert both[0] == joined[0] and (both[1] == joined[1]).all() and (both[2] == joined[2]).all()
            for fill in range(budget + 2):
                _, out = p.apply((0, fill, 0), [a])
                assert out == (len(a), p.summarise([a])[1][fill], p.summarise([a])[2][fill])


@pytest.mark.parametrize("parts,segment", [(1, 1 << 20), (12, 4)])
def test_automaton_and_sums(spark, parts, segment):
    rnd = random.Random(parts)
    rows = [(g, i, *[rnd.randint(0, 2) for _ in range(3)], *[rnd.randint(0, 4) for _ in range(3)])
            for g, n in [("a", 300), ("b", 1), ("c", 40), (None, 9)] for i in range(n)]
    df = spark.createDataFrame(rows, "g string, i long, t0 int, t1 int, t2 int, a0 long, a1 long, a2 long")
    m = S.Automaton(["t0", "t1", "t2"], ["a0", "a1", "a2"], "state", "n")
    got = {(r.g, r.i): (r.state, r.n) for r in S.segmented_scan(df, "g", ["i"], m, n_parts=parts, segment_rows=segment).collect()}
    sums = {(r.g, r.i): r.x for r in S.segmented_scan(df, "g", ["i"], S.RunningSums({"x": "a1"}), n_parts=parts, segment_rows=segment).collect()}
    now = object()
    for r in rows:
        if r[0] != now:
            now, state, n, total = r[0], 0, 0, 0
        total += r[6]
        assert got[r[:2]] == (state, n) and sums[r[:2]] == total
        n += r[5 + state]
        state = r[2 + state]


def test_empty_table(spark):
    df = spark.createDataFrame([], "g long, i long, s long")
    out = S.segmented_scan(df, "g", ["i"], S.Packing("s", 8))
    assert out.columns == ["g", "i", "s", "pos", "bin", "ends"] and out.count() == 0

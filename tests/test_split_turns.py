"""Turns that hold separators: the post-level path equals splitting the joined text."""

import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from lexis.plans.registry import oracles, queries
from lexis.sources import tables as V

PIECES = ["|||", "|", "||", "||||", "a b", "http://x.y/z ", "", " ", "it is a longer post with words. ", "x|||y", "end|"]


def turns(seed, people=60):
    rnd = random.Random(seed)
    return [(p, i * 2, rnd.choice([None, *["".join(rnd.choices(PIECES, k=rnd.randint(0, 4)))] * 12]))
            for p in range(people) for i in range(rnd.randint(1, 8))]


@pytest.mark.parametrize("seed", [1, 2])
def test_split_turns_equals_joined_text(spark, seed):
    rows = turns(seed) + [(100, i, "w |||" * (i % 3) + "|" * (i % 4)) for i in range(400)] + [(101, 0, None)]
    df = spark.createDataFrame(rows, "person_id long, post_no long, post string")
    got = sorted(map(tuple, V.split_turns(df).collect()))
    people = {}
    for p, _, t in sorted(rows, key=lambda r: r[:2]):
        if t is not None:
            people.setdefault(p, []).append(t)
    want = [(p, i, x) for p, ts in people.items() for i, x in enumerate("|||".join(ts).split("|||"))]
    assert got == sorted(want)


@pytest.fixture(scope="module")
def tables(tmp_path_factory):
    """Conversations with separators inside turns beside the given documents and labels."""
    import os
    from conftest import SF001
    d = tmp_path_factory.mktemp("turns")
    rows = [(p, i, "user", t or "") for p, i, t in turns(5, 80)]
    pq.write_table(pa.table({"conv_id": pa.array([r[0] for r in rows], pa.int64()), "turn": pa.array([r[1] for r in rows], pa.int64()),
                             "role": [r[2] for r in rows], "text": [r[3] for r in rows]}), str(d / "conversations.parquet"))
    for t in ("documents", "labels"):
        os.symlink(f"{SF001}/{t}.parquet", d / f"{t}.parquet")
    return str(d)


@pytest.mark.parametrize("name", ["hist_post", "usable_posts", "clean_mask_post", "pack_by_class", "packed_tokens", "pack_by_person",
                                  "hist_person", "hist_before_after", "sentences_filtered"])
def test_queries_with_separators_inside_turns(spark, tables, name):
    import duckdb
    con = duckdb.connect()
    for t in ("conversations", "documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tables}/{t}.parquet'")
    rel = con.execute(oracles()[name])
    cols = [c[0] for c in rel.description]
    got = queries()[name](spark, tables).select(*cols)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(rel.fetchall(), key=str)

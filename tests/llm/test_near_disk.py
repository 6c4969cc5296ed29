"""What the near-duplicates stage keeps on disk and how often it moves the texts."""

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lexis.llm.shingle_join import JaccardGroups, keep_one_of_each  # noqa: E402
from test_jaccard import corpus  # noqa: E402


def frame(spark, texts):
    return spark.createDataFrame([(None if i % 17 == 5 else i // 2, t) for i, t in enumerate(texts)], "doc_id long, text string")


def test_whole_rows_are_shuffled_once(spark):
    """A side of a join and the repeated rows have the same key: both parts of the result read one exchange."""
    kept = keep_one_of_each(frame(spark, corpus(3)), width=5, percent=80)
    before = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        plan = kept.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    moved = [x for x in plan.split("\n") if re.search(r"Exchange hashpartitioning", x) and "ReusedExchange" not in x]
    by_row = [x for x in moved if re.search(r"hashpartitioning\(_(at|id|h)#|hashpartitioning\(coalesce\(_id#|hashpartitioning\(xxhash64", x)]
    assert len({re.sub(r"#\d+L?|plan_id=\d+|\+-|[*:()\d ]|- ", "", x) for x in by_row}) == 1, plan


def test_tables_of_earlier_steps_go(spark):
    """Classes, columns, heads, candidates and sets are deleted when the groups are known."""
    docs = frame(spark, corpus(4))
    groups = JaccardGroups(docs, width=5, percent=80)
    groups.rows().count()
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(groups.stored.base)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    left = {int(s.getPath().getName()) for s in fs.listStatus(path)}
    wide = {n for n in left if {"prefix", "set", "t"} & set(spark.read.parquet(f"{groups.stored.base}/{n}").columns)}
    assert not wide


def test_repeated_rows_and_null_ids(spark):
    """One row of equal ids and texts stays; rows without words all stay."""
    same = "one two three four five six seven eight"
    rows = [(1, same, 10), (1, same, 11), (None, same, 12), (2, same + " nine", 13), (None, "", 14), (None, "", 15), (3, None, 16), (3, None, 17)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, more int")
    got = sorted((r.doc_id is None, r.doc_id or 0, r.more) for r in keep_one_of_each(docs, width=5, percent=75).collect())
    assert [g[:2] for g in got] == [(False, 1), (False, 3), (False, 3), (True, 0), (True, 0)]
    assert [g[2] for g in got[1:]] == [16, 17, 14, 15]

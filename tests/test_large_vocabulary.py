"""A vocabulary larger than tasks hold: only tokens beyond its first terms leave their row."""

from pyspark.sql import functions as F

from lexis.operators import features as FT


def tables(spark):
    vocab = spark.createDataFrame([(w, i + 2) for i, w in enumerate("aa bb cc ü dd ee ff".split())], "term string, id int")
    rows = [(1, "aa ff bb ee unseen aa".split()), (2, "dd".split()), (3, []), (4, None), (None, "ee aa".split()), (5, "aa bb".split()),
            (6, "ü ff cc".split()), (6, "ff dd".split()), (7, [None, "ee", "aa"])]
    return vocab, spark.createDataFrame(rows, "doc_id long, tokens array<string>")


def result(df, col):
    return sorted(((r.doc_id is None, r.doc_id, r[col]) for r in df.collect()), key=str)


def test_rows_equal_those_of_the_join(spark):
    vocab, docs = tables(spark)
    want = result(FT.encode_rows(docs, vocab, max_terms=0), "tokens")
    for most in (1, 3, 6):
        ids = FT.encode_rows(docs, vocab, max_terms=most)
        assert result(ids, "tokens") == want
    ids = spark.createDataFrame([(1, [2, 8, 3, 7, 1, 2]), (2, [6]), (3, []), (4, None), (None, [7, 0]), (6, [5, 8, 4]), (6, [8, 6]), (7, [None, 99, -1, 7])],
                                "doc_id long, tokens array<int>")
    want = result(FT.decode(ids, vocab, max_terms=0), "text")
    for some in (ids, ids.where("doc_id <> 6")):
        mine = [x for x in want if x[1] != 6] if some is not ids else want
        mine = mine if some is ids else [x for x in mine if not x[0]]
        for most in (1, 3, 6):
            assert result(FT.decode(some, vocab, max_terms=most), "text") == mine


def test_only_late_terms_are_joined(spark):
    """The rows that meet the vocabulary are the tokens beyond the first terms, not all tokens."""
    vocab, docs = tables(spark)
    docs = docs.union(spark.range(10, 200).select("id", F.array(*[F.lit("aa")] * 40)))
    for df in (FT.encode_rows(docs, vocab, max_terms=3), FT.decode(FT.encode_rows(docs, vocab), vocab, max_terms=3)):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan()
        seen, todo = [], [plan]
        while todo:
            p = todo.pop()
            name = p.nodeName()
            if "Join" in name:
                seen.append(p.metrics().get("numOutputRows").get().value())
            for q in ([p.executedPlan()] if name.startswith("AdaptiveSparkPlan") else [p.plan()] if "QueryStage" in name else [p.child()] if name.startswith("ResultQueryStage") else []):
                todo.append(q)
            kids = p.children()
            todo += [kids.apply(i) for i in range(kids.size())]
        assert seen and max(seen) < 20

"""What is exploded from documents is grouped where it is: texts are shuffled, not their tokens."""

import pytest
from pyspark.sql import functions as F

from lexis.operators import features as FT
from lexis.plans import q_chunk, q_features
from lexis.plans.registry import queries
from lexis.sources import tables as V


@pytest.fixture(scope="module")
def many_files(spark, tmp_path_factory):
    """A documents table of more files than cores, with repeated and null keys and null texts."""
    d = str(tmp_path_factory.mktemp("files"))
    n = spark.sparkContext.defaultParallelism + 4
    rows = [(i % 40 if i % 17 else None, None if i % 13 == 0 else f"aa bb{i % 5} cc{i % 7} aa dd x ee{i}") for i in range(30 * n)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(n).write.option("parquet.block.size", 1024).parquet(f"{d}/documents.parquet")
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 27))
    yield d, rows
    spark.conf.unset("spark.sql.files.openCostInBytes")


def exchanges(df) -> str:
    df.collect()
    p = df._jdf.queryExecution().executedPlan().toString()
    return p[p.index("Final Plan"):p.index("Initial Plan")]


def test_term_counts_shuffle_texts_only(spark, many_files):
    d, rows = many_files
    assert spark.read.parquet(f"{d}/documents.parquet").rdd.getNumPartitions() > spark.sparkContext.defaultParallelism
    tf = q_features._tf(spark, d)
    assert exchanges(tf).count("Exchange hashpartitioning(doc_id") == 1 and "hashpartitioning(doc_id#0L, term" not in exchanges(tf)
    assert exchanges(tf).count("Exchange") == 1
    want = {}
    for i, t in rows:
        for w in (t or "").split():
            if len(w) > 1:
                want[i, w] = want.get((i, w), 0) + 1
    assert {(r.doc_id, r.term): r.tf for r in tf.collect()} == want


def test_encoding_shuffles_texts_only(spark, many_files):
    d, rows = many_files
    e, vocab = q_chunk.doc_ids(spark, d)
    assert exchanges(e).count("Exchange hashpartitioning(doc_id") == 1 and "Exchange hashpartitioning(term" not in exchanges(e)
    ids = {r.term: r.id for r in vocab.collect()}
    want = {}
    for i, t in rows:
        want.setdefault(i, []).append([ids[w] for w in (t or "").split() if len(w) > 1])
    got = {r.doc_id: r.tokens for r in e.collect()}
    assert {i: sorted(t) for i, t in got.items()} == {i: sorted(sum(t, [])) for i, t in want.items()}


def test_decode_leaves_tokens_in_their_rows(spark):
    vocab = spark.createDataFrame([("aa", 2), ("ü b", 3), ("c", 4)], "term string, id int")
    ids = spark.createDataFrame([(1, [2, 3, 0, 4]), (2, [9, 1, 2]), (3, []), (4, None), (5, [None, -1, 4])], "doc_id long, tokens array<int>")
    one, two = FT.decode(ids, vocab), FT.decode(ids, vocab, max_terms=0)
    want = {1: "aa ü b [PAD] c", 2: "[UNK] [UNK] aa", 5: "[UNK] [UNK] c"}
    assert {r.doc_id: r.text for r in one.collect()} == want == {r.doc_id: r.text for r in two.collect()}
    assert "Generate" not in one._jdf.queryExecution().optimizedPlan().toString()
    gaps = vocab.withColumn("id", F.col("id") * 2)                       # joined: not a table without gaps
    assert {r.doc_id: r.text for r in FT.decode(ids, gaps).collect()}[1] == "[UNK] [UNK] [PAD] aa"


def test_vocabulary_of_the_vectors_is_made_once(spark):
    docs = spark.createDataFrame([(1, "aa bb bb"), (2, "aa"), (3, "")], "doc_id long, text string")
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    vocab = spark.createDataFrame([("bb", 1), ("aa", 2)], "term string, df long").coalesce(1).mapInArrow(count, "term string, df long")
    v = {r.doc_id: r.features for r in FT.tfidf_vectors(docs, vocab, 3).collect()}
    assert seen.value == 2 and v[2].toArray().tolist() == [1.0, 0.0] and v[1].toArray()[1] > v[1].toArray()[0]
    with pytest.raises(ValueError):
        FT.tfidf_vectors(docs, vocab, 3, max_terms=1)


def test_load_by_key_without_it_keeps_the_scan(spark, many_files):
    d, _ = many_files
    kinds = [V.load(spark, d, "documents", by_key)._jdf.queryExecution().optimizedPlan().toString() for by_key in (False, True)]
    assert "Repartition" not in kinds[0] and "Repartition" in kinds[1]
    assert queries()["vocab_decode"](spark, d).count() > 0


def test_rows_are_encoded_without_token_rows(spark):
    """Arrays of tokens encoded in their row equal the exploded and joined ones, also for repeated and null ids."""
    rows = [(1, ["b", "a", "b"]), (2, ["zz", "a"]), (3, []), (4, None), (5, ["a"] * 40), (1, ["c", "a"]), (1, ["b", "a", "b"]), (None, ["c"])]
    docs = spark.createDataFrame(rows, "doc_id long, tokens array<string>").repartition(3, "doc_id")
    vocab = spark.createDataFrame([("a", 2), ("b", 3), ("c", 4)], "term string, id int")
    long = docs.select("doc_id", F.posexplode("tokens").alias("pos", "term"))
    want = {r["doc_id"]: r["tokens"] for r in FT.encode(long, vocab).collect()}
    assert want[2] == [1, 2] and want[1] == [3, 3, 4, 2, 2, 2, 3, 3]
    for most in (10, 2):                                   # held by the tasks, joined
        got = FT.encode_rows(docs, vocab, max_terms=most)
        assert {r["doc_id"]: r["tokens"] for r in got.collect()} == want
    assert "posexplode" not in FT.encode_rows(docs, vocab)._jdf.queryExecution().optimizedPlan().toString().lower()

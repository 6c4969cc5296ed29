"""Lemma rules on hand-made words."""

from pyspark.sql import functions as F

from lexis.operators import features as FT

CASES = {  # form: base form when the base forms below are words of the corpus
    "children": "child", "went": "go", "stories": "story", "cities": "city", "movies": "movie", "wolves": "wolf", "knives": "knife",
    "loves": "love", "halves": "half", "watches": "watch", "wishes": "wish", "classes": "class", "boxes": "box", "heroes": "hero",
    "shoes": "shoe", "houses": "house", "cats": "cat", "loved": "love", "jumped": "jump", "tried": "try", "making": "make", "reading": "read",
    "firemen": "fireman", "was": "be"}
BASES = ["story", "city", "movie", "knife", "love", "half", "watch", "wish", "class", "box", "hero", "shoe", "house", "cat", "jump", "try",
         "make", "read", "fireman"]
UNCHANGED = ["glass", "bus", "this", "red", "as", "zebras", "wing", "story"]       # no base form among the words, or none


def test_lemma_table(spark):
    words = [*CASES, *BASES, *UNCHANGED, None, "", "cats"]
    got = {r.word: r.lemma for r in FT.lemma_table(spark.createDataFrame([(w,) for w in words], "word string")).collect()}
    assert got == CASES
    rows = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, word string")
    out = FT.apply_lemmas(rows, FT.lemma_table(rows))
    assert [r.word for r in out.orderBy("i").collect()] == [CASES.get(w, w) for w in words]


def test_ngram_sets(spark):
    df = spark.createDataFrame([(["a", "b", "a", "b", "c"],), (["a"],), ([],)], "t array<string>")
    got = [(r.x, r.y) for r in df.select(FT.ngram_sets("t", 2).alias("x"), FT.ngram_sets(F.col("t"), 3).alias("y")).collect()]
    assert got == [(["a b", "b a", "b c"], ["a b a", "b a b", "a b c"]), ([], []), ([], [])]

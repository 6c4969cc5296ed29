"""Literal fixtures for the text steps (rules restated from the survey)."""

from pyspark.sql import functions as F

from conftest import one
from lexis.functions import text as T
from lexis.operators import clean as C
from lexis.operators import chunk as K


def test_triple_truncate_stops_at_punctuation(spark):
    assert one(spark, T.triple_truncate, "so good sooo long tail. next") == "so good s. next"


def test_triple_truncate_after_letters_only_eats_rest(spark):
    assert one(spark, T.triple_truncate, "so good sooo long tail next") == "so good s"


def test_drop_short_words(spark):
    assert one(spark, T.drop_short_words, "a bcd efgh") == "  efgh"


def test_drop_long_words_keeps_over_1000(spark):
    w30, w1001 = "a" * 30, "b" * 1001
    assert one(spark, T.drop_long_words, f"x {w30} y {w1001}") == f"x  y {w1001}"


def test_squeeze_repeats(spark):
    assert one(spark, T.squeeze_repeats, "sooo --- ___") == "so - _"


def test_trim_ends(spark):
    assert one(spark, T.trim_ends, "I'm not sure") == "'m not sur"
    assert one(spark, T.trim_ends, "x") == ""


def test_request_sentences(spark):
    df = spark.createDataFrame([("Hi. Bye.",)], "x string")
    r = df.select(K.request_sentences_col("x").alias("r")).first()["r"]
    assert r == ["Hi.", " Bye.", "."]


def test_usable_post_rule(spark):
    df = spark.createDataFrame([(" [MASK] ok go on",), ("a b c",)], "post string")
    out = C.clean_mask_post(df, "post", keep_unusable=True).select("post", "usable").collect()
    got = {r["post"]: r["usable"] for r in out}
    assert got[" [MASK] ok go on"] is True
    assert got["a b c"] is False


def test_label_strip_is_a_chain(spark):
    # deleting an earlier word can create a later one, which the chain removes;
    # a re-created earlier word stays (one pass per word)
    assert one(spark, T.strip_label_words, "inentpfp x") == " x"
    assert one(spark, T.strip_label_words, "ininfjfj x") == "infj x"


def test_url_class_range_matches_upper_case_and_digits(spark):
    assert one(spark, lambda c: T.url_mask(c, "U"), "see http://A.b/C?x=1|rest") == "see U|rest"


def test_lazy_url_drops_through_whitespace(spark):
    assert one(spark, T.url_strip_ws, "a https://x.y/z b") == "a b "


def test_word_counts(spark):
    df = spark.createDataFrame([("a  b ",), ("",), ("x",)], "t string")
    assert [r[0] for r in df.select(T.space_parts("t")).collect()] == [4, 1, 1]


def test_stop_words_keep_order_and_duplicates(spark):
    df = spark.createDataFrame([("the cat and the cat",)], "t string")
    r = df.select(F.array_join(T.remove_stop_words(F.split("t", " ")), " ")).first()[0]
    assert r == "cat cat"


def test_quote_trim_and_close(spark):
    assert one(spark, T.trim_quotes_close, "'hello'") == "hello."
    assert one(spark, T.trim_quotes_close, "'") == ""
    assert one(spark, T.trim_quotes_close, "done?") == "done?"


def test_unicode_word_classes(spark):
    # Unicode letters are word characters (Python semantics)
    assert one(spark, T.strip_punct, "héllo, wörld!") == "héllo wörld"

"""Registered text queries (single steps TXT-* and pipelines CLN-*).

Inputs: ``documents`` (whole texts), ``pages`` as URL-bearing text,
labelled documents whose text carries label words, and the person/post views
over ``conversations``.  Every query returns (key, result) per input row.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lexis.functions import text as T
from lexis.operators import clean as C
from lexis.operators.features import LEMMA_EXCEPTIONS, LEMMA_RULES, lemma_table
from lexis.operators.ranking import bounded_broadcast
from lexis.plans import sqlviews as S
from lexis.plans.registry import query
from lexis.session import store
from lexis.sources import tables as V


def _docs(spark, d):
    return V.load(spark, d, "documents").select("doc_id", "text")


def _single(name, col_fn, sql_fn, source="docs"):
    """Register a one-step text query over a source view."""
    if source == "docs":
        src_sql = "documents"
        get = _docs
    elif source == "url":
        src_sql = "url_docs"
        get = V.url_docs
    else:
        src_sql = "tagged"
        get = V.tagged_docs
    prefix = ""
    if source == "url":
        prefix = S.with_(S.URL_DOCS_CTE)
    elif source == "tagged":
        prefix = S.with_(S.TAGGED_CTE)
    sql = f"{prefix}SELECT doc_id, {sql_fn('text')} AS out FROM {src_sql}"

    @query(name, sql)
    def _q(spark, d):
        return get(spark, d).select("doc_id", col_fn(F.col("text")).alias("out"))
    return _q


_single("txt_url_ws", T.url_strip_ws, S.url_strip_ws, "url")
_single("txt_eos_tokens", T.eos_tokens, S.eos_tokens)
_single("txt_punct", T.strip_punct, S.strip_punct)
_single("txt_letters", T.letters_only, S.letters_only)
_single("txt_letters_space", T.letters_to_space, S.letters_to_space)
_single("txt_letters_space_ws", lambda c: T.letters_to_space(c, True), lambda x: S.letters_to_space(x, True))
_single("txt_lower", F.lower, lambda x: f"lower({x})")
_single("txt_triple_truncate", lambda c: T.triple_truncate(F.lower(c)), lambda x: S.triple_truncate(f"lower({x})"))
_single("txt_drop_short", lambda c: T.drop_short_words(T.letters_only(c)),
        lambda x: S.drop_short_words_ascii(S.letters_only(x)))
_single("txt_drop_long", lambda c: T.drop_long_words(T.letters_only(c)),
        lambda x: S.drop_long_words_ascii(S.letters_only(x)))
_single("txt_ws_collapse", T.collapse_same_ws, S.collapse_same_ws)
_single("txt_spaces_collapse", T.collapse_spaces, S.collapse_spaces)
_single("txt_url_mask", T.url_mask, S.url_mask, "url")
_single("txt_url_star", T.url_star, S.url_star, "url")
_single("txt_digit_mask", T.digit_mask, S.digit_mask)
_single("txt_squeeze", T.squeeze_repeats, S.squeeze_repeats)
_single("txt_drop_ellipsis", T.drop_ellipsis, lambda x: f"replace({x}, '...', '')")
_single("txt_label_strip", lambda c: T.strip_label_words(F.lower(c)),
        lambda x: S.strip_label_words(f"lower({x})"), "tagged")
_single("txt_label_star", lambda c: T.label_words_to(F.lower(c), "*", upper=False),
        lambda x: S.label_words_to(f"lower({x})", "*", upper=False), "tagged")
_single("txt_label_mask", lambda c: T.label_words_to(c, " [MASK] "),
        lambda x: S.label_words_to(x, " [MASK] "), "tagged")
_single("txt_star_mask", T.star_to_mask, S.star_to_mask)
_single("txt_trim_ends", T.trim_ends, S.trim_ends)
_single("txt_trim_quoted", T.trim_quoted, S.trim_quoted)
_single("txt_trim_quotes", T.trim_quotes, S.trim_quotes)
_single("txt_close_sentence", T.close_sentence, S.close_sentence)
_single("txt_any_triple_truncate", T.any_triple_truncate, S.any_triple_truncate)
_single("txt_separators_drop", T.separators_drop, S.separators_drop)
_single("txt_stopwords", lambda c: F.array_join(T.remove_stop_words(F.split(F.lower(c), " ", -1)), " "),
        lambda x: f"array_to_string(list_filter(string_split(lower({x}), ' '), "
                  f"lambda w: NOT list_contains({S.STOP_LIST_SQL}, w)), ' ')")


@query("txt_mask_density", S.with_(S.TAGGED_CTE, """
m AS (SELECT doc_id, """ + S.label_words_to("text", " [MASK] ") + """ AS x FROM tagged)""") + f"""
SELECT doc_id, {S.mask_count('x')} AS n_masks, CAST({S.space_parts('x')} AS BIGINT) AS n_parts,
       round({S.mask_count('x')} / {S.space_parts('x')}, 6) AS mask_density FROM m""")
def txt_mask_density(spark, d):
    x = V.tagged_docs(spark, d).select("doc_id", T.label_words_to("text", " [MASK] ").alias("x"))
    n = T.space_parts("x")
    return x.select("doc_id", T.mask_count("x").alias("n_masks"), n.cast("bigint").alias("n_parts"),
                    F.round(T.mask_count("x") / n, 6).alias("mask_density"))


@query("txt_separators", S.with_(S.POSTS_CTE) + f"""
SELECT person_id, {S.separators_dot('posts')} AS dot_form, {S.separators_drop('posts')} AS drop_form,
       replace(posts, '|', ' ') AS space_form FROM posts""")
def txt_separators(spark, d):
    p = V.posts(spark, d)
    return p.select("person_id", T.separators_dot("posts").alias("dot_form"),
                    T.separators_drop("posts").alias("drop_form"), T.pipes_to_space("posts").alias("space_form"))


@query("txt_word_count", rf"""
SELECT doc_id, CAST(len(string_split(text, ' ')) AS INTEGER) AS n_space_parts,
       CAST(len(regexp_extract_all(text, '{S.W}+')) AS INTEGER) AS n_word_regex,
       CAST(len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> '')) AS INTEGER) AS n_ws_words
FROM documents""")
def txt_word_count(spark, d):
    x = _docs(spark, d)
    return x.select("doc_id", T.space_parts("text").alias("n_space_parts"),
                    T.word_count_regex("text").alias("n_word_regex"), T.word_count_ws("text").alias("n_ws_words"))


# ---------------------------------------------------------------------------
# pipelines
# ---------------------------------------------------------------------------
@query("clean_profile", S.with_(S.POSTS_CTE) + f"SELECT person_id, {S.clean_profile('posts')} AS clean FROM posts")
def clean_profile(spark, d):
    return V.posts(spark, d).select("person_id", C.clean_profile_col(F.col("posts")).alias("clean"))


@query("clean_profile_docs", f"SELECT doc_id, {S.clean_profile('text')} AS clean FROM documents")
def clean_profile_docs(spark, d):
    return _docs(spark, d).select("doc_id", C.clean_profile_col(F.col("text")).alias("clean"))


@query("clean_bow", S.with_(S.TAGGED_CTE) + f"SELECT doc_id, {S.clean_bow('text')} AS clean FROM tagged")
def clean_bow(spark, d):
    return V.tagged_docs(spark, d).select("doc_id", C.clean_bow_col(F.col("text")).alias("clean"))


@query("clean_light", S.with_(S.POSTS_CTE) + f"SELECT person_id, {S.clean_light('posts')} AS clean FROM posts")
def clean_light(spark, d):
    return V.posts(spark, d).select("person_id", C.clean_light_col(F.col("posts")).alias("clean"))


@query("clean_mask_lower", S.with_(S.TAGGED_CTE, """
pre AS (SELECT doc_id, """ + S.collapse_same_ws(
    "replace(" + S.squeeze_repeats(S.digit_mask(S.url_star("lower(text)"))) + ", '...', '')") + """ AS x FROM tagged)""")
    + f"SELECT doc_id, {S.label_words_to(S.trim_quoted('x'), '*', upper=False)} AS clean FROM pre")
def clean_mask_lower(spark, d):
    return V.tagged_docs(spark, d).select("doc_id", C.clean_mask_lower_col(F.col("text")).alias("clean"))


_MASK_POST_SQL = S.with_(S.POSTS_CTE, f"""
pre AS (SELECT person_id, post_no, {S.clean_mask_post_pre('post')} AS x FROM post_rows),
tq AS (SELECT person_id, post_no, x, {S.trim_quotes('x')} AS y FROM pre),
cl AS (SELECT person_id, post_no, x, {S.close_sentence('y')} AS clean FROM tq)""") + f"""
SELECT person_id, post_no, clean, {S.mask_count('x')} AS n_masks FROM cl
WHERE {S.space_parts('clean')} > 3 AND {S.mask_count('x')} <= {S.space_parts('clean')} * 0.5"""


@query("clean_mask_post", _MASK_POST_SQL)
def clean_mask_post(spark, d):
    pr = V.post_rows(spark, d)
    return C.clean_mask_post(pr, "post").select("person_id", "post_no", "clean", "n_masks")


@query("usable_posts", S.with_(S.POSTS_CTE, f"""
pre AS (SELECT person_id, post_no, {S.clean_mask_post_pre('post')} AS x FROM post_rows),
tq AS (SELECT person_id, post_no, x, {S.trim_quotes('x')} AS y FROM pre),
cl AS (SELECT person_id, post_no, x, {S.close_sentence('y')} AS clean FROM tq)""") + f"""
SELECT person_id, count(*) AS n_posts,
       count(*) FILTER (WHERE {S.space_parts('clean')} > 3 AND {S.mask_count('x')} <= {S.space_parts('clean')} * 0.5)
         AS n_usable
FROM cl GROUP BY person_id""")
def usable_posts(spark, d):
    pr = C.clean_mask_post(V.post_rows(spark, d), "post", keep_unusable=True)
    return pr.groupBy("person_id").agg(F.count(F.lit(1)).alias("n_posts"),
                                       F.count_if("usable").alias("n_usable"))


@query("clean_request", S.with_(S.POSTS_CTE) + f"SELECT person_id, {S.clean_request('posts')} AS clean FROM posts")
def clean_request(spark, d):
    return V.posts(spark, d).select("person_id", C.clean_request_col(F.col("posts")).alias("clean"))


@query("clean_long", S.with_(S.TAGGED_CTE, f"""
pre AS (SELECT doc_id, {S.collapse_same_ws(S.separators_drop(S.squeeze_repeats(S.url_star('text', '[MASK]'))))} AS x
        FROM tagged)""") + f"SELECT doc_id, {S.label_words_to(S.trim_quoted('x'), '[MASK]')} AS clean FROM pre")
def clean_long(spark, d):
    return V.tagged_docs(spark, d).select("doc_id", C.clean_long_col(F.col("text")).alias("clean"))


# lemma-table bag-of-words clean: forms by suffix rules, checked against the corpus's own words
def _lemma_sql() -> str:
    forms = ", ".join(f"CASE WHEN word LIKE '%{x}' THEN left(word, length(word) - {len(x)}) || '{y}' END" for x, y in LEMMA_RULES)
    odd = ", ".join(f"('{k}', '{v}')" for k, v in LEMMA_EXCEPTIONS.items())
    return f"""
vocab AS (SELECT DISTINCT word FROM x),
odd AS (SELECT * FROM (VALUES {odd}) t(word, lemma)),
c AS (SELECT word, unnest([{forms}]) AS stem, unnest(range({len(LEMMA_RULES)})) AS k FROM vocab
      WHERE length(word) > 3 AND NOT regexp_matches(word, '(ss|us|is)$') AND word NOT IN (SELECT word FROM odd)),
lem AS (SELECT c.word, arg_min(c.stem, c.k) AS lemma FROM c JOIN vocab v ON v.word = c.stem WHERE length(c.stem) > 1 GROUP BY c.word
        UNION ALL SELECT v.word, o.lemma FROM vocab v JOIN odd o ON o.word = v.word)"""


@query("txt_lemma_join", S.with_(S.TAGGED_CTE, f"""
w AS (SELECT doc_id, {S.clean_bow_words('text')} AS ws FROM tagged),
x AS (SELECT doc_id, unnest(ws) AS word, unnest(generate_series(1, len(ws))) AS pos FROM w),""" + _lemma_sql() + f""",
y AS (SELECT x.doc_id, x.pos, coalesce(lem.lemma, x.word) AS word FROM x LEFT JOIN lem ON x.word = lem.word),
z AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS s FROM y GROUP BY doc_id)""") + f"""
SELECT t.doc_id, {S.strip_label_words("coalesce(z.s, '')")} AS clean FROM tagged t LEFT JOIN z ON t.doc_id = z.doc_id""")
def txt_lemma_join(spark, d):
    t = V.tagged_docs(spark, d).select("doc_id", "text")
    w = store(t.select("doc_id", C.clean_bow_words("text").alias("words")), "words")      # the cleaned chain runs once
    lem = bounded_broadcast(store(lemma_table(w.select(F.explode("words").alias("word"))), "lemmas"))
    out = w.select("doc_id").join(C.lemmatised(w, lem), "doc_id", "left")
    return out.select("doc_id", F.coalesce(T.strip_label_words("clean"), F.lit("")).alias("clean"))

"""Composite cleaning pipelines.  Each is a fixed chain of built-in column
expressions (one projection, whole-stage codegen), applied with
``df.transform(clean_x("text"))`` or as a Column via ``clean_x_col``.

Order matters: later steps rely on what earlier steps left behind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexis.functions import text as T


def with_once(df: DataFrame, **cols: Column) -> DataFrame:
    """Add expensive columns that later filters or expressions read more than
    once.  They are produced by a one-element ``inline`` (a Generate node), so
    Catalyst cannot substitute copies of the expression into pushed-down
    filters: each is evaluated once per row."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in cols.items()]))))


def clean_profile_col(c) -> Column:
    """Profile clean: URL drop, sentence-end words, punctuation, letters only,
    lower case, truncate at a tripled letter, drop 1-3 and 30-1000 letter
    words, collapse whitespace runs.  (The label-word pattern of this
    pipeline is compiled but never applied in the reference: no-op here.)"""
    x = T.url_strip_ws(c)
    x = T.eos_tokens(x)
    x = T.strip_punct(x)
    x = T.letters_only(x)
    x = F.lower(x)
    x = T.triple_truncate(x)
    x = T.drop_short_words(x)
    x = T.drop_long_words(x)
    return T.collapse_same_ws(x)


def clean_bow_words(c, stop_words=None) -> Column:
    """Bag-of-words clean up to the word list (before lemmas): URL to space,
    non-letters to space, collapse spaces, lower, truncate at a tripled letter,
    split on single spaces and drop stop words (order and duplicates kept)."""
    x = T.url_mask(c, " ")
    x = T.letters_to_space(x)
    x = F.lower(T.collapse_spaces(x))
    x = T.triple_truncate(x)
    return T.remove_stop_words(F.split(x, " ", -1), stop_words)


def clean_bow_col(c, stop_words=None) -> Column:
    """Bag-of-words clean without a lemma table (lemma = word)."""
    return T.strip_label_words(F.array_join(clean_bow_words(c, stop_words), " "))


def clean_bow(df: DataFrame, text_col: str = "text", lemmas: DataFrame | None = None,
              id_col: str = "doc_id", out_col: str = "clean", stop_words=None) -> DataFrame:
    """Bag-of-words clean with an optional lemma table ``(word, lemma)``.

    With lemmas the word list is exploded with positions, left-joined to the
    lemma table (broadcast only when AQE measures it small) and re-assembled
    in position order per document, then label words are stripped.
    """
    if lemmas is None:
        return df.withColumn(out_col, clean_bow_col(text_col, stop_words))
    back = lemmatised(df.select(id_col, clean_bow_words(text_col, stop_words).alias("words")), lemmas, id_col, out_col)
    return df.join(back, id_col, "left").withColumn(out_col, T.strip_label_words(out_col))


def lemmatised(words: DataFrame, lemmas: DataFrame, id_col: str = "doc_id", out_col: str = "clean") -> DataFrame:
    """``id, out`` from ``id, words``: the words of an id by their lemmas, in position
    order and joined by spaces; ids without words have no row.  Rows go to their id's
    partition before they are exploded, so word rows are grouped where they are."""
    from lexis.operators.features import apply_lemmas
    w = words.repartition(id_col).select(id_col, F.posexplode("words").alias("pos", "word"))
    return apply_lemmas(w, lemmas).groupBy(id_col).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "word"))),
                                 lambda s: s["word"]), " ").alias(out_col))


def clean_light_col(c) -> Column:
    """Light clean: drop first/last char, ``...|||`` -> ``.``, ``|||`` -> space."""
    return T.separators_dot(T.trim_ends(c))


def clean_mask_lower_col(c) -> Column:
    """Masked lower-case clean (chunked person model)."""
    x = F.lower(c if isinstance(c, Column) else F.col(c))
    x = T.url_star(x, "* ")
    x = T.digit_mask(x)
    x = T.squeeze_repeats(x)
    x = T.drop_ellipsis(x)
    x = T.collapse_same_ws(x)
    x = T.trim_quoted(x)
    return T.label_words_to(x, "*", upper=False, lower=True)


def clean_mask_post_regex(c) -> Column:
    """Per-post mask clean, regex part (before the mask count and trimming)."""
    x = T.url_mask(c, " [MASK] ")
    x = T.digit_mask(x)
    x = T.squeeze_repeats(x)
    x = T.label_words_to(x, " [MASK] ")
    x = T.star_to_mask(x)
    x = T.collapse_same_ws(x)
    return T.any_triple_truncate(x)


def clean_mask_post_cols(c) -> tuple[Column, Column]:
    """Per-post mask clean: returns (clean text, mask count before trimming)."""
    x = clean_mask_post_regex(c)
    return T.trim_quotes_close(x), T.mask_count(x)


def usable(clean: Column, masks: Column) -> Column:
    """A post is usable with > 3 space-split parts and masks <= half of them."""
    n = T.space_parts(clean)
    return (n > 3) & (masks <= n * 0.5)


def clean_mask_post(df: DataFrame, text_col: str = "post", out_col: str = "clean",
                    keep_unusable: bool = False) -> DataFrame:
    # The trimming steps and the usability filter read the regex result many
    # times.  A plain alias would be substituted back into the pushed-down
    # filter (copies of the whole regex chain); producing it through a
    # one-element ``inline`` (a Generate node) evaluates it once per row and
    # filters stay above it.
    x = with_once(df, _mp=clean_mask_post_regex(F.col(text_col)))
    out = x.withColumn(out_col, T.trim_quotes_close(F.col("_mp"))).withColumn("n_masks", T.mask_count(F.col("_mp"))) \
        .drop("_mp")
    if keep_unusable:
        return out.withColumn("usable", usable(F.col(out_col), F.col("n_masks")))
    return out.where(usable(F.col(out_col), F.col("n_masks")))


def clean_request_col(c) -> Column:
    """Request clean (scoring path): separators deleted, URL mask, digits,
    squeeze, star mask, whitespace runs, any-triple truncation."""
    x = T.separators_drop(c)
    x = T.url_mask(x, " [MASK] ")
    x = T.digit_mask(x)
    x = T.squeeze_repeats(x)
    x = T.star_to_mask(x)
    x = T.collapse_same_ws(x)
    return T.any_triple_truncate(x)


def clean_long_col(c) -> Column:
    """Long-text clean: lazy URL -> [MASK], squeeze, delete ``|||``, collapse,
    quote trim, label words -> [MASK] (no spaces)."""
    x = T.url_star(c, "[MASK]")
    x = T.squeeze_repeats(x)
    x = T.separators_drop(x)
    x = T.collapse_same_ws(x)
    x = T.trim_quoted(x)
    return T.label_words_to(x, "[MASK]")

"""Scoring of texts and chunks into per-axis probabilities, and the
chunk-averaged request score.

A *scorer* maps a text column to four logit columns (IE, NS, FT, JP).  The
default ``rule_logits`` is a transparent baseline built from text statistics
(all built-in expressions); a fitted Spark ML model or a user model applied
with ``mapInPandas`` can stand in its place (see ``lexis.operators.models``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexis.functions import labels as L
from lexis.functions import text as T
from lexis.operators.clean import with_once

AXES = L.AXES


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_stats(text) -> dict[str, Column]:
    x = _c(text)
    letters = F.length(F.regexp_replace(x, r"[^\p{L}]", ""))
    ascii_letters = F.length(F.regexp_replace(x, "[^a-zA-Z]", ""))
    words = F.size(F.regexp_extract_all(x, F.lit(f"[{T.WORD}]+"), F.lit(0)))
    return {
        "ascii_ratio": ascii_letters / F.greatest(letters, F.lit(1)),
        "n_excl": F.length(x) - F.length(F.replace(x, F.lit("!"), F.lit(""))),
        "avg_word": letters / F.greatest(words, F.lit(1)),
        "n_chars": F.length(x),
    }


def rule_logits(text) -> list[Column]:
    """Baseline logits per axis: English-ness, exclamation density, word
    length and text length."""
    s = text_stats(text)
    return [
        (s["ascii_ratio"] - F.lit(0.9)) * 20.0,
        (s["n_excl"] - F.lit(3.0)) / 2.0,
        s["avg_word"] - F.lit(5.0),
        (s["n_chars"] - F.lit(2000.0)) / 500.0,
    ]


def sigmoid(x) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_c(x)))


def score_axes(df: DataFrame, text_col: str, scorer=rule_logits) -> DataFrame:
    """Adds ``logit_<axis>``, ``p_<axis>`` (probability of bit 1) and ``pred_<axis>``.
    Logits and probabilities are computed once for a row, however often later
    expressions (16 products of four of them) read them."""
    names = [ax.lower() for ax in AXES]
    out = with_once(df, **{f"logit_{a}": lg for a, lg in zip(names, scorer(F.col(text_col)))})
    out = with_once(out, **{f"p_{a}": sigmoid(f"logit_{a}") for a in names})
    return out.select(*df.columns, *[c for a in names for c in (
        F.col(f"logit_{a}"), F.col(f"p_{a}"), (F.col(f"p_{a}") >= 0.5).cast("int").alias(f"pred_{a}"))])


def axis_long(df: DataFrame, id_col: str, target_cols: list[str]) -> DataFrame:
    """Wide per-axis predictions -> long (id, axis, logit, p, pred, target)."""
    parts = []
    for ax, t in zip(AXES, target_cols):
        a = ax.lower()
        parts.append(F.struct(F.lit(ax).alias("axis"), F.col(f"logit_{a}").alias("logit"), F.col(f"p_{a}").alias("p"),
                              F.col(f"pred_{a}").alias("pred"), F.col(t).cast("int").alias("target")))
    return df.select(id_col, F.explode(F.array(*parts)).alias("s")).select(id_col, "s.*")


def class_probs(df: DataFrame) -> Column:
    """16 class probabilities (code A order) from four independent axis probabilities."""
    ps = [F.col(f"p_{ax.lower()}") for ax in AXES]
    out = []
    for code in range(16):
        term = F.lit(1.0)
        for i in range(4):
            b = (code >> (3 - i)) & 1
            term = term * (ps[i] if b else (F.lit(1.0) - ps[i]))
        out.append(term)
    return F.array(*out)


def argmax_first(probs) -> Column:
    """0-based index of the largest value; the first one wins on ties."""
    p = _c(probs)
    return (F.array_position(p, F.array_max(p)) - 1).cast("int")


def chunk_scores(chunks: DataFrame, request_col: str, text_col: str, scorer=rule_logits) -> DataFrame:
    """Mean probability per (request, axis) over the request's chunks, x100.
    A partial + final aggregate: a request with many chunks is pre-aggregated."""
    s = score_axes(chunks, text_col, scorer)
    aggs = [F.count(F.lit(1)).alias("n_chunks")]
    aggs += [(F.avg(f"p_{ax.lower()}") * 100).alias(f"score_{ax.lower()}") for ax in AXES]
    return s.groupBy(request_col).agg(*aggs)


def scores_to_labels(scores: DataFrame, request_col: str) -> DataFrame:
    """4 tags + 4 scores: first letter when the mean probability >= 50, else
    the second; the I/E tag is swapped and its score becomes 100 - s.  Also the
    response confidences ``max(s, 100 - s)`` rounded to two places."""
    ps = [F.col(f"score_{ax.lower()}") / 100 for ax in AXES]
    cols = L.score_tags(*ps)
    tags, vals = cols[:4], cols[4:]
    out = scores.select(request_col, F.concat(*tags).alias("type_pred"),
                        *[v.alias(f"s_{ax.lower()}") for v, ax in zip(vals, AXES)])
    return out.select("*", *[L.confidence(f"s_{ax.lower()}").alias(f"conf_{ax.lower()}") for ax in AXES])


# The letter of each axis whose record bit is 1.
RECORD_ONE_LETTERS = "INFJ"


def record_text(type_col: str = "type_pred", score_prefix: str = "s_") -> Column:
    """Scoring record: four lines of tag bits (1 when the tag is I, N, F or J)
    then the four scores, newline-separated."""
    t = F.col(type_col)
    bits = [F.when(F.substring(t, i + 1, 1) == RECORD_ONE_LETTERS[i], "1").otherwise("0") for i in range(4)]
    # a request without chunks has no score: keep eight lines ("nan")
    scores = [F.coalesce(F.col(f"{score_prefix}{a.lower()}").cast("string"), F.lit("nan")) for a in AXES]
    return F.concat_ws("\n", *bits, *scores)


def decode_record(c) -> list[Column]:
    """Record -> type letters and four confidences formatted with two
    decimals (the score if above 50, else 100 minus it)."""
    lines = F.split(_c(c), "\n", -1)
    letters = []
    for i, (one, zero) in enumerate(zip(RECORD_ONE_LETTERS, "ESTP")):
        letters.append(F.when(F.element_at(lines, i + 1).cast("int") == 1, F.lit(one)).otherwise(F.lit(zero)))
    confs = []
    for i, a in enumerate(AXES):
        s = F.element_at(lines, i + 5).cast("double")
        confs.append(F.format_string("%.2f", F.when(s > 50, s).otherwise(F.lit(100.0) - s)).alias(f"conf_{a.lower()}"))
    return [F.concat(*letters).alias("type")] + confs

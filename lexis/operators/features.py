"""Text features: tokens, term statistics, vocabularies, count / TF-IDF
vectors (long form and Spark ML vectors), n-gram features, id encoding.

Long form ``(doc_id, term, tf)`` is the working representation: it is what
joins, aggregates and oracles use; ML vectors are built at the edge.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from lexis.functions import text as T
from lexis.operators.ranking import bounded_broadcast, global_dense_rank, global_row_number

PAD_ID = 0
UNK_ID = 1
FIRST_ID = 2


def tokens_long(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                stop_words: list[str] | None = None) -> DataFrame:
    """One row per token occurrence: (id, pos, term).  Tokens are 2+ word
    characters, lower-cased; stop words optional."""
    toks = T.word_tokens(text_col)
    if stop_words is not None:
        toks = T.remove_stop_words(toks, stop_words)
    return df.select(id_col, F.posexplode(toks).alias("pos", "term"))


def term_counts(tokens: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, term, tf): partial + final aggregate, no skew on hot terms."""
    return tokens.groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf"))


def term_stats(tf_long: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Corpus frequency and document frequency per term."""
    return tf_long.groupBy("term").agg(F.sum("tf").alias("tf"), F.count(F.lit(1)).alias("df"))


def count_vectors_long(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       stop_words: list[str] | None = None) -> DataFrame:
    """Count vectors in long form with the alphabetical term index."""
    tf = term_counts(tokens_long(df, id_col, text_col, stop_words), id_col)
    return global_dense_rank(tf, ["term"], "term_index")


def df_limited_vocabulary(tf_long: DataFrame, n_docs: Column | int, min_df: float = 0.1,
                          max_df: float = 0.7, max_features: int | None = 1000) -> DataFrame:
    """Terms with ``min_df*n <= df <= max_df*n``, then the ``max_features`` most
    frequent (corpus tf desc, term asc).  Returns (term, tf, df)."""
    st = term_stats(tf_long)
    n = F.lit(n_docs) if isinstance(n_docs, int) else n_docs
    kept = st.where((F.col("df") >= n * min_df) & (F.col("df") <= n * max_df))
    if max_features is not None:
        kept = kept.orderBy(F.desc("tf"), F.asc("term")).limit(max_features)  # TakeOrderedAndProject
    return kept


def tfidf_long(tf_long: DataFrame, vocab: DataFrame, n_docs: Column | int, id_col: str = "doc_id") -> DataFrame:
    """Smoothed TF-IDF with rows L2-normalised:
    idf = ln((1 + n) / (1 + df)) + 1; value = tf * idf / ||tf * idf||_2.
    A vocabulary limited by ``max_features`` is broadcast by its known size; an
    unlimited one is joined by shuffle."""
    n = F.lit(n_docs) if isinstance(n_docs, int) else n_docs
    v = vocab.select("term", (F.log((n + 1) / (F.col("df") + 1)) + 1).alias("idf"))
    x = tf_long.join(v, "term").withColumn("w", F.col("tf") * F.col("idf"))
    # a window group is one document's terms; where the table was spread by
    # document (tables.load on small inputs) the tf rows are clustered by it
    # already, elsewhere the norm costs one more shuffle of (id, term, tf) rows
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(id_col)))
    return x.select(id_col, "term", "tf", (F.col("w") / norm).alias("tfidf"))


def tfidf_vectors(docs: DataFrame, vocab: DataFrame, n_docs: int, id_col: str = "doc_id",
                  text_col: str = "text", max_terms: int = 100_000) -> DataFrame:
    """TF-IDF as Spark ML sparse vectors, all JVM-side: a CountVectorizerModel
    over the limited vocabulary, an ElementwiseProduct with the smoothed idf
    and an L2 Normalizer.  The vocabulary (and so the idf vector) is bounded
    by ``max_features``; its size is checked before it is read to the driver."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
    from pyspark.ml.linalg import Vectors
    rows = vocab.select("term", "df").limit(max_terms + 1).collect()        # read once: counting it first would make it twice
    if len(rows) > max_terms:
        raise ValueError(f"vocabulary larger than {max_terms} terms; use the long form")
    rows.sort(key=lambda r: r["term"])
    terms = [r["term"] for r in rows]
    import math
    idf = Vectors.dense([math.log((1 + n_docs) / (1 + r["df"])) + 1 for r in rows])
    cv = CountVectorizerModel.from_vocabulary(terms, inputCol="_tok", outputCol="_tf")
    ep = ElementwiseProduct(scalingVec=idf, inputCol="_tf", outputCol="_w")
    nm = Normalizer(p=2.0, inputCol="_w", outputCol="features")
    base = docs.select(id_col, T.word_tokens(text_col).alias("_tok"))
    return PipelineModel(stages=[cv, ep, nm]).transform(base).select(id_col, "features")


def ngram_sets(tokens, n: int) -> Column:
    """The distinct n-grams of a token array, words joined by a space."""
    t = F.col(tokens) if isinstance(tokens, str) else tokens
    places = F.when(F.size(t) >= n, F.sequence(F.lit(1), F.size(t) - (n - 1))).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(places, lambda i: F.array_join(F.slice(t, i, n), " ")))


def ngram_presence(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   ns=(2, 3, 4), num_features: int = 1 << 18, keep: tuple[str, ...] = ()) -> DataFrame:
    """Binary hashed n-gram presence features for n in ``ns`` (Spark ML NGram +
    HashingTF + VectorAssembler): the column-parallel stand-in for a bank of
    2/3/4-wide convolutions with max pooling.  Columns in ``keep`` stay beside them."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import HashingTF, NGram, VectorAssembler
    base = df.select(id_col, *keep, T.word_tokens(text_col).alias("_tok"))
    stages, outs = [], []
    for n in ns:
        stages.append(NGram(n=n, inputCol="_tok", outputCol=f"_ng{n}"))
        stages.append(HashingTF(inputCol=f"_ng{n}", outputCol=f"_h{n}", numFeatures=num_features, binary=True))
        outs.append(f"_h{n}")
    stages.append(VectorAssembler(inputCols=outs, outputCol="features"))
    model = Pipeline(stages=stages).fit(base)
    return model.transform(base).select(id_col, *keep, "features")


# ---------------------------------------------------------------------------
# vocabulary id encoding
# ---------------------------------------------------------------------------
def build_vocabulary(tokens: DataFrame) -> DataFrame:
    """(term, id, freq): ids by corpus frequency desc, then term; 0 = pad and
    1 = unknown are reserved.  Numbering is distributed (range partitions)."""
    freq = tokens.groupBy("term").agg(F.count(F.lit(1)).alias("freq"))
    ranked = global_row_number(freq, [F.desc("freq"), F.asc("term")], "_r")
    return ranked.select("term", (F.col("_r") + FIRST_ID).cast("int").alias("id"), "freq")


def encode(tokens: DataFrame, vocab: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Token rows (id, pos, term) -> one id array per document in position order;
    unknown terms -> UNK_ID.  The vocabulary is broadcast when its counted size
    is bounded (no shuffle of the token stream by term, so frequent terms do
    not skew); a shuffled join otherwise.  Position and id travel as one whole
    number, position first."""
    j = tokens.join(bounded_broadcast(vocab.select("term", "id")), "term", "left") \
        .select(id_col, (F.shiftleft(F.col("pos").cast("long"), 32) + F.coalesce("id", F.lit(UNK_ID))).alias("_at"))
    return j.groupBy(id_col).agg(
        F.transform(F.sort_array(F.collect_list("_at")), lambda x: x.bitwiseAND(F.lit((1 << 32) - 1)).cast("int")).alias("tokens"))


def encode_rows(docs: DataFrame, vocab: DataFrame, id_col: str = "doc_id", tokens_col: str = "tokens", max_terms: int = 1_000_000) -> DataFrame:
    """Token arrays -> id arrays: the rows of ``encode`` on the exploded arrays.

    The ``max_terms`` first ids (the most frequent terms) are held by every task and tokens are
    looked up in their row, so that rows of documents are grouped by id instead of
    rows of tokens (of several rows with one id the tokens are merged by position).
    Only tokens beyond those are exploded and joined with the rest of the vocabulary."""
    docs = docs.select(id_col, F.col(tokens_col).alias("_tok"))
    vocab = vocab.select("term", "id")
    more = vocab.count() > max_terms
    head = vocab.where(F.col("id") < FIRST_ID + max_terms) if more else vocab
    if more and not 0 < head.count() <= max_terms:
        return encode(docs.select(id_col, F.posexplode("_tok").alias("pos", "term")), vocab, id_col)
    held = head.toArrow()
    terms, known = held["term"].combine_chunks(), held["id"].combine_chunks().cast(pa.int32())

    def bounds_of(lists) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))])

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("_tok")
            tokens = lists.flatten()
            found = known.take(pc.index_in(tokens, terms.cast(tokens.type)))
            found = found if more else pc.fill_null(found, UNK_ID)
            yield pa.RecordBatch.from_arrays([b.column(id_col), pa.ListArray.from_arrays(pa.array(bounds_of(lists), pa.int32()), found)], [id_col, "_ids"])

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("_tok")
            tokens, bounds = lists.flatten(), bounds_of(lists)
            at = np.flatnonzero(pc.is_null(pc.index_in(tokens, terms.cast(tokens.type))).to_numpy(zero_copy_only=False))
            row = np.searchsorted(bounds, at, "right") - 1
            yield pa.RecordBatch.from_arrays([b.column(id_col).take(pa.array(row)), pa.array((at - bounds[row]).astype(np.int64)),
                                              tokens.take(pa.array(at)).cast(pa.string())], [id_col, "pos", "term"])
    key, some = docs.schema[id_col], docs.where(F.size("_tok") > 0)
    schema = Ty.StructType([key, Ty.StructField("_ids", Ty.ArrayType(Ty.IntegerType()))])
    rows = some.mapInArrow(look_up, schema)
    if more:
        schema = Ty.StructType([key, Ty.StructField("pos", Ty.LongType()), Ty.StructField("term", Ty.StringType())])
        rest = some.mapInArrow(others, schema).join(vocab.where(F.col("id") >= FIRST_ID + max_terms), "term", "left") \
            .select(id_col, F.lit(None).cast("array<int>").alias("_ids"), (F.shiftleft("pos", 32) + F.coalesce("id", F.lit(UNK_ID))).alias("_at"))
        rows = rows.select(id_col, "_ids", F.lit(None).cast("long").alias("_at")).union(rest)
    rows = rows.groupBy(id_col).agg(F.collect_list("_ids").alias("_all"), *[F.collect_list("_at").alias("_rest")] * more)
    placed = F.flatten(F.transform("_all", lambda ids: F.transform(ids, lambda x, i: F.shiftleft(i.cast("long"), 32) + x)))
    if more:
        placed = F.concat(F.filter(placed, lambda x: x.isNotNull()), "_rest")
    merged = F.transform(F.sort_array(placed), lambda x: x.bitwiseAND(F.lit((1 << 32) - 1)).cast("int"))
    whole = (F.size("_all") == 1) & (F.size("_rest") == 0) if more else F.size("_all") == 1
    return rows.select(id_col, F.when(whole, F.col("_all")[0]).otherwise(merged).alias("tokens"))


def decode(ids: DataFrame, vocab: DataFrame, id_col: str = "doc_id", tokens_col: str = "tokens", max_terms: int = 1_000_000) -> DataFrame:
    """Id arrays -> text (inverse lookup in position order).

    Of a vocabulary whose ids run from ``FIRST_ID`` without gaps the first ``max_terms`` terms
    are one array that every task holds: an id is a place in it, so these
    tokens do not leave their row.  Only ids beyond them are exploded, joined with the rest of the
    vocabulary and put back by position (the rows of an id are one text then, as with the join).
    Other vocabularies are joined and the rows re-assembled.  An id without tokens has no row."""
    terms = vocab.select("term", "id")
    n, low, high, known = terms.agg(F.count(F.lit(1)), F.min("id"), F.max("id"), F.count_distinct("id")).first()
    special = lambda i: F.when(i == PAD_ID, F.lit("[PAD]")).otherwise(F.lit("[UNK]"))
    if n and max_terms > 0 and n == known and (low, high) == (FIRST_ID, FIRST_ID + n - 1):
        end = FIRST_ID + max_terms
        held = terms.where(F.col("id") < end).toArrow().sort_by("id")["term"].to_pylist()
        held = pa.array(["[PAD]", "[UNK]", *held], pa.large_string())

        def first_terms(at: pa.Array) -> pa.Array:
            at = pc.fill_null(at, UNK_ID)
            return held.take(pc.if_else(pc.and_(pc.greater_equal(at, PAD_ID), pc.less(at, len(held))), at, UNK_ID))

        def record(b: pa.RecordBatch, lengths: np.ndarray, terms: pa.Array) -> pa.RecordBatch:
            bounds = pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int64())
            text = pc.binary_join(pa.LargeListArray.from_arrays(bounds, terms), pa.scalar(" ", pa.large_string()))
            return pa.RecordBatch.from_arrays([b.column(id_col), text.cast(pa.string())], [id_col, "text"])

        def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                lists = b.column(tokens_col)
                lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
                yield record(b, lengths, first_terms(lists.flatten()))

        def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                lists, rest = b.column("_all"), b.column("_rest")
                tokens, spare = lists.flatten().flatten(), rest.flatten()
                lengths = np.array([sum(map(len, x)) for x in lists.to_pylist()], np.int64)
                starts = np.cumsum(lengths) - lengths
                terms = first_terms(tokens)
                at = np.repeat(starts, pc.list_value_length(rest).to_numpy(zero_copy_only=False)) + spare.field("pos").to_numpy()
                order = np.argsort(at)
                mask = np.zeros(len(terms), bool)
                if (pc.list_value_length(lists).to_numpy(zero_copy_only=False) == 1).all():
                    mask[at] = True
                    new = spare.field("term").cast(pa.large_string()).take(pa.array(order))
                    yield record(b, lengths, pc.replace_with_mask(terms, pa.array(mask), new))
                    continue
                texts = []                                    # several rows of an id: by position, then term
                for arrays, odd in zip(lists.to_pylist(), rest.to_pylist()):
                    items = [(p, held[UNK_ID if t is None or not PAD_ID <= t < len(held) else t].as_py())
                             for a in arrays for p, t in enumerate(a) if t is None or t < end]
                    texts.append(" ".join(w for _, w in sorted(items + [(x["pos"], x["term"]) for x in odd])))
                yield pa.RecordBatch.from_arrays([b.column(id_col), pa.array(texts, pa.string())], [id_col, "text"])
        schema = Ty.StructType([ids.schema[id_col], Ty.StructField("text", Ty.StringType())])
        ids = ids.where(F.size(tokens_col) > 0).select(id_col, tokens_col)
        if n <= max_terms:
            return ids.mapInArrow(words, schema)
        rest = ids.select(id_col, F.posexplode(tokens_col).alias("pos", "id")).where(F.col("id") >= end).join(terms.where(F.col("id") >= end), "id", "left")
        odd = F.struct("pos", F.coalesce("term", F.lit("[UNK]")).alias("term"))
        rows = ids.select(id_col, F.col(tokens_col).alias("_ids"), F.lit(None).cast("struct<pos:int,term:string>").alias("_odd")) \
            .union(rest.select(id_col, F.lit(None).cast("array<int>"), odd))
        return rows.groupBy(id_col).agg(F.collect_list("_ids").alias("_all"), F.collect_list("_odd").alias("_rest")).mapInArrow(merged, schema)
    x = ids.select(id_col, F.posexplode(tokens_col).alias("pos", "id"))
    j = x.join(bounded_broadcast(terms), "id", "left") \
        .select(id_col, "pos", F.coalesce("term", special(F.col("id"))).alias("term"))
    return j.groupBy(id_col).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "term"))), lambda s: s["term"]), " ")
        .alias("text"))


# ---------------------------------------------------------------------------
# lemmas
# ---------------------------------------------------------------------------
# Irregular English forms and their base forms.
LEMMA_EXCEPTIONS = {
    "children": "child", "men": "man", "women": "woman", "people": "person", "feet": "foot", "teeth": "tooth", "geese": "goose",
    "mice": "mouse", "oxen": "ox", "dice": "die", "wolves": "wolf", "leaves": "leaf", "criteria": "criterion", "phenomena": "phenomenon",
    "analyses": "analysis", "crises": "crisis", "indices": "index", "vertices": "vertex", "news": "news", "series": "series",
    "species": "species", "better": "good", "best": "good", "worse": "bad", "worst": "bad", "was": "be", "were": "be", "been": "be",
    "went": "go", "gone": "go", "had": "have", "has": "have", "did": "do", "done": "do", "said": "say", "made": "make", "took": "take",
    "taken": "take", "came": "come", "saw": "see", "seen": "see", "knew": "know", "known": "know", "got": "get", "gave": "give",
    "given": "give", "thought": "think", "told": "tell", "felt": "feel", "left": "leave", "kept": "keep", "began": "begin", "wrote": "write"}

# Suffixes and what replaces them, the longest suffix first; of equal ones the likelier.
LEMMA_RULES = [("ches", "ch"), ("shes", "sh"), ("sses", "ss"), ("xes", "x"), ("zes", "z"), ("oes", "o"), ("ves", "ve"), ("ves", "f"),
               ("ves", "fe"), ("ies", "y"), ("ies", "ie"), ("ied", "y"), ("men", "man"), ("ing", ""), ("ing", "e"), ("es", "e"), ("es", ""),
               ("ed", "e"), ("ed", ""), ("s", "")]


def lemma_candidates(word) -> Column:
    """The base forms that the rules propose for a word of more than three letters, in
    the rules' order (null where a rule does not apply); a word in -ss, -us or -is is no plural."""
    w = F.col(word) if isinstance(word, str) else word
    plain = (F.length(w) > 3) & ~w.endswith("ss") & ~w.endswith("us") & ~w.endswith("is")
    forms = []
    for suffix, new in LEMMA_RULES:
        stem = F.concat(F.substring(w, F.lit(1), F.length(w) - len(suffix)), F.lit(new))
        forms.append(F.when(plain & w.endswith(suffix) & (F.length(stem) > 1), stem))
    return F.array(*forms)


def lemma_table(words: DataFrame, word_col: str = "word") -> DataFrame:
    """``word, lemma`` for the words of a corpus: an irregular form's base form, or else the
    first form proposed by the longest suffix that is itself a word of the corpus.
    Other words, and null ones, have no row."""
    vocab = words.select(F.col(word_col).alias("word")).where(F.col(word_col).isNotNull()).distinct()
    known = F.create_map(*[F.lit(x) for pair in LEMMA_EXCEPTIONS.items() for x in pair])
    odd = vocab.select("word", F.try_element_at(known, "word").alias("lemma"))
    forms = odd.where("lemma IS NULL").select("word", F.posexplode(lemma_candidates("word")).alias("rank", "stem")).where("stem IS NOT NULL")
    hits = forms.join(vocab.select(F.col("word").alias("stem")), "stem").groupBy("word").agg(F.min_by("stem", "rank").alias("lemma"))
    return odd.where("lemma IS NOT NULL").unionByName(hits)


def apply_lemmas(word_rows: DataFrame, lemmas: DataFrame, word_col: str = "word") -> DataFrame:
    """Replace each word by its lemma when the table has one (left join)."""
    j = word_rows.join(lemmas.select(F.col("word").alias("_w"), "lemma"), F.col(word_col) == F.col("_w"), "left")
    return j.withColumn(word_col, F.coalesce("lemma", word_col)).drop("_w", "lemma")


def sort_by_length(df: DataFrame, tokens_col: str = "tokens") -> DataFrame:
    return df.orderBy(F.size(tokens_col), *[c for c in df.columns if c != tokens_col])


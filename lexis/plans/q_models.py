"""Registered model queries (MOD-1..4, MOD-6..11).

Labelled documents -> profile clean, at least 20 words -> hashed counts ->
stratified seeded 15% hold-out -> fit -> predict, one row per test document.
Label = alphabetical class index of the four-letter type.  The models have no
SQL form; ``model_split`` (who is in which side, with which label) has, and
tests hold the models against the majority class.
"""

from __future__ import annotations

from pyspark.ml.feature import HashingTF, StringIndexer
from pyspark.sql import functions as F

from lexis.functions import labels as L
from lexis.functions import text as T
from lexis.operators import boosting as BO
from lexis.operators import clean as C
from lexis.operators import features as FT
from lexis.operators import linear as LN
from lexis.operators import models as MD
from lexis.operators import perceptron as PC
from lexis.operators import split as SP
from lexis.plans import sqlviews as S
from lexis.plans.registry import query
from lexis.session import let_go, scratch_path, store, unstore
from lexis.sources import tables as V

MIN_WORDS = 20


def _cleaned(spark, d, clean=C.clean_profile_col):
    """Labelled documents whose cleaned text has at least MIN_WORDS words, with the class index."""
    a = V.axes(spark, d).withColumn("label", L.flip("code").cast("double"))
    x = C.with_once(a, clean=clean(F.col("text"))).drop("text").withColumnRenamed("clean", "text")
    return x.where(T.word_count_ws("text") >= MIN_WORDS)


def _split(x):
    """Adds ``split``: ids and labels alone are ranked, texts and features join the result."""
    side = SP.split_stratified(x.select("doc_id", "label"), "doc_id", "label", 0.15, 1).select("doc_id", "split")
    return x.join(side, "doc_id")


def _tokens(x):
    """``x`` with its text as tokens without stop words, written once: the cleaned chain runs
    once, whatever reads the rows (ranks, features, iterations)."""
    return store(x.withColumn("tok", F.coalesce(T.remove_stop_words(T.word_tokens("text")), F.array().cast("array<string>"))).drop("text"), "tokens")


def _data(spark, d, num_features: int = MD.HASH_FEATURES, clean=C.clean_profile_col):
    x = _tokens(_cleaned(spark, d, clean))
    sp = _split(MD.HashingTF(inputCol="tok", outputCol="features", numFeatures=num_features).transform(x).drop("tok"))
    return sp.where("split = 'train'"), sp.where("split = 'test'")


def _sharded(spark, d, y, heads: int, loss: str, clean=C.clean_profile_col, weighted: bool = False, c: float = 1.0, **options):
    """Margins (z) of the test rows by a linear model on 2^18 hashed counts (``weighted``:
    TF-IDF rows of length one), with all columns but the text; weights stay in tables
    (see ``operators.linear``)."""
    x = _cleaned(spark, d, clean)
    tokens = T.remove_stop_words(T.word_tokens("text"))
    x = store(x.withColumn("buckets", LN.hashed(tokens, MD.HASH_FEATURES)).drop("text"), "buckets")
    sp = store(_split(x), "sides")
    unstore(x)
    let_go(spark)
    n = sp.where("split = 'train'").count()
    blocks = max(8, -(-n // LN.BLOCK_ROWS))
    rows = sp.select("split", F.col("doc_id").alias("id"), y.alias("y"), "buckets")
    train, test = (LN.counted(rows.where(F.col("split") == side), MD.HASH_FEATURES, blocks) for side in ("train", "test"))
    if weighted:
        train = store(train, "train")
        df = LN.document_counts(train)
        train, test = store(LN.tf_idf(train, n, df, MD.HASH_FEATURES), "train"), LN.tf_idf(test, n, df, MD.HASH_FEATURES)
    model = LN.fit(train, heads, MD.HASH_FEATURES, loss, l2=1.0 / (c * max(n, 1)), n_blocks=blocks, **options)
    return model.margins(test).select(F.col("id").alias("doc_id"), "z").join(sp.drop("buckets", "split"), "doc_id")


def _fit(est, train, test, features_col: str = "features"):
    """Fit on cached training rows (iterative fits read them many times), then let them go."""
    train = train.persist()
    try:
        return MD.fit_predict(est, train, test, features_col)
    finally:
        train.unpersist()


def _fit_each_class(est, train, test, features_col: str = "features"):
    """One binary model for each class seen in training: their codes are numbered
    without gaps for the fit and put back into the predictions."""
    codes = [int(r["label"]) for r in train.select("label").distinct().orderBy("label").collect()]      # at most 16
    known = F.array(*[F.lit(c) for c in codes])
    numbered = train.withColumn("label", (F.array_position(known, F.col("label").cast("int")) - 1).cast("double"))
    pred = _fit(est, numbered, test, features_col)
    return pred.withColumn("prediction", F.element_at(known, F.col("prediction").cast("int") + 1).cast("double"))


def _out(pred):
    return pred.select("doc_id", F.col("label").cast("int").alias("label"),
                       F.col("prediction").cast("int").alias("prediction"))


_SPLIT_SQL = S.with_(S.AXES_CTE) + f"""
, cl AS (SELECT doc_id, code, {S.clean_profile('text')} AS clean FROM axes),
ok AS (SELECT doc_id, CAST((code + 8) % 16 AS INTEGER) AS label FROM cl
       WHERE len(list_filter(regexp_split_to_array(trim(clean), '\\s+'), lambda w: w <> '')) >= {MIN_WORDS}),
""" + S.stratified_sizes_cte("sz", "ok", "label") + """,
r AS (SELECT doc_id, label, row_number() OVER (PARTITION BY label ORDER BY md5(CAST(doc_id AS VARCHAR) || ':1'), doc_id) - 1 AS rk FROM ok)
SELECT r.doc_id, r.label, CASE WHEN r.rk < sz.n_test THEN 'test' ELSE 'train' END AS split FROM r JOIN sz ON r.label = sz.label"""


@query("model_split", _SPLIT_SQL)
def model_split(spark, d):
    """The side and class of every usable document, as all count models see them."""
    return _split(store(_cleaned(spark, d).select("doc_id", "label"), "usable")).select(
        "doc_id", F.col("label").cast("int").alias("label"), "split")


@query("model_rf")
def model_rf(spark, d):
    """Random forest of 200 trees, 16 classes."""
    tr, te = _data(spark, d, MD.TREE_FEATURES)
    return _out(_fit(MD.random_forest(200), tr, te))


@query("model_gbt")
def model_gbt(spark, d):
    """Boosted trees: 200 rounds of one tree for each of the 16 classes, depth 6, on 2^18 hashed counts."""
    sp = store(_split(_tokens(_cleaned(spark, d))), "sides")
    rows = sp.select("split", F.col("doc_id").alias("id"), F.col("label").cast("int").alias("y"), LN.hashed("tok", MD.HASH_FEATURES).alias("buckets"))
    model = BO.fit(rows.where("split = 'train'"), 16, MD.HASH_FEATURES, rounds=200)
    z = model.scores(rows.where("split = 'test'"))
    return z.select(F.col("id").alias("doc_id"), F.col("y").alias("label"), LN.argmax("z").alias("prediction"))


@query("model_linear_svc")
def model_linear_svc(spark, d):
    """Hinge-loss linear model (squared hinge), 16 classes one against the rest, all trained at once; up to 10 iterations."""
    z = _sharded(spark, d, LN.one_hot("label", 16), 16, "hinge", max_iter=10)
    return _out(z.withColumn("prediction", LN.argmax("z")))


@query("model_logreg")
def model_logreg(spark, d):
    """Multinomial logistic regression, C = 1, on all 2^18 buckets; up to 100
    iterations, fewer once one lowers the loss by less than 0.2 %."""
    z = _sharded(spark, d, LN.one_hot("label", 16), 16, "softmax", max_iter=100, tol=2e-3)
    return _out(z.withColumn("prediction", LN.argmax("z")))


@query("model_rff_svm")
def model_rff_svm(spark, d):
    """RBF-kernel SVM approximated by random Fourier features + linear SVC."""
    x = MD.random_fourier_features(_tokens(_cleaned(spark, d)), "tok", 1 << 15, 128, gamma=0.01)
    sp = store(_split(x.select("doc_id", "label", "rff")), "sides")
    return _out(_fit_each_class(MD.linear_svc(10), sp.where("split = 'train'"), sp.where("split = 'test'"), "rff"))


def _axis_predictions(spark, d):
    """Four binary heads on TF-IDF of the bag-of-words clean, trained together, C = 3;
    up to 100 iterations, fewer once one lowers the loss by less than 0.2 %."""
    names = [x.lower() for x in L.AXES]
    y = F.array(*[F.col(f"b_{a}").cast("double") for a in names])
    z = _sharded(spark, d, y, 4, "sigmoid", C.clean_bow_col, True, max_iter=100, c=3.0, tol=2e-3)
    return z.select("doc_id", *[(F.col("z")[i] > 0).cast("int").alias(f"pred_{a}") for i, a in enumerate(names)],
                    *[F.col(f"b_{a}").cast("int").alias(f"b_{a}") for a in names])


@query("model_axes")
def model_axes(spark, d):
    """Four binary axis classifiers on TF-IDF features: per axis the accuracy
    and F1, plus the recombined 16-class accuracy (one row each), all from one
    pass of cells."""
    from lexis.operators import metrics as M
    names = [a.lower() for a in L.AXES]
    c = M.scope_cells(_axis_predictions(spark, d), [f"pred_{a}" for a in names], [f"b_{a}" for a in names])
    tp, fp, fn = (F.sum(F.when((F.col("pred") == p) & (F.col("actual") == t), F.col("n")).otherwise(0)) for p, t in ((1, 1), (1, 0), (0, 1)))
    right = F.sum(F.when(F.col("pred") == F.col("actual"), F.col("n")).otherwise(0))
    g = c.groupBy("scope").agg((right / F.sum("n")).alias("accuracy"), F.coalesce(F.try_divide(tp * 2, tp * 2 + fp + fn), F.lit(0.0)).alias("f1_binary"))
    every = F.col("scope") == "ALL"
    return g.select(F.when(every, "recombined").otherwise(F.col("scope")).alias("model"), "accuracy",
                    F.when(~every, F.col("f1_binary")).alias("f1_binary"))


@query("model_axes_matrix")
def model_axes_matrix(spark, d):
    """The recombined 16 x 16 matrix of the four fitted axis models (rows: predicted)."""
    from lexis.operators import metrics as M
    names = [a.lower() for a in L.AXES]
    codes = M.recombined(_axis_predictions(spark, d), "doc_id", [f"pred_{a}" for a in names], [f"b_{a}" for a in names])
    return M.confusion_long(codes, "pred_code", "actual_code", 16)


NGRAM_FEATURES = 1 << 11


def _ngram_data(spark, d):
    """Training and test rows with their features; rows are split with their texts, so that
    the features of a side are made for its rows alone."""
    a = V.axes(spark, d).select("doc_id", "text", "code", "b_ie")
    sp = _split(a.select("doc_id", "text").join(a.select("doc_id", F.col("code").alias("label"), "code", "b_ie"), "doc_id"))
    return tuple(FT.ngram_presence(sp.where(F.col("split") == side), "doc_id", "text", (2, 3, 4), NGRAM_FEATURES, ("label", "code", "b_ie", "split"))
                 for side in ("train", "test"))


@query("model_mlp_axis")
def model_mlp_axis(spark, d):
    """n-gram presence features + perceptron with 2 outputs (I/E axis)."""
    tr, te = _ngram_data(spark, d)
    tr = tr.withColumn("label", F.col("b_ie").cast("double"))
    te = te.withColumn("label", F.col("b_ie").cast("double"))
    return _out(PC.fit(MD.mlp(3 * NGRAM_FEATURES, 2, 16, 50), tr).transform(te))


@query("model_mlp_16")
def model_mlp_16(spark, d):
    """n-gram presence features + perceptron with 16 soft-max outputs; the
    class probabilities feed the soft confusion matrix (actual, class, p_sum)."""
    from pyspark.ml.functions import vector_to_array
    from lexis.operators import metrics as M
    tr, te = _ngram_data(spark, d)
    tr = tr.withColumn("label", L.flip("code").cast("double"))
    te = te.withColumn("label", L.flip("code").cast("double"))
    p = PC.fit(MD.mlp(3 * NGRAM_FEATURES, 16, 16, 50), tr).transform(te)
    p = p.withColumn("probs", vector_to_array("probability"))
    return M.confusion_soft(p, "label", "probs").select("actual", "class", F.round("p_sum", 6).alias("p_sum"))


@query("batch_score")
def batch_score(spark, d):
    """Batch scoring of packed chunks by fitted models of all four axes, written and read
    back (MOD-11): sigmoid heads on hashed counts, trained on the documents that are not
    scored, applied to each person's 300-word chunks; per chunk and axis prediction and target."""
    from lexis.plans.q_chunk import _pack_person
    names = [a.lower() for a in L.AXES]
    ch = store(_pack_person(spark, d).select("person_id", "chunk_no", "type", T.word_tokens("chunk").alias("tok")), "chunks")
    a = V.axes(spark, d).join(ch.select(F.col("person_id").alias("_p")).distinct(), F.col("doc_id") == F.col("_p"), "left_anti")
    y = F.array(*[F.col(f"b_{x}").cast("double") for x in names])
    rows = store(a.select(F.col("doc_id").alias("id"), y.alias("y"), LN.hashed(T.word_tokens("text"), MD.HASH_FEATURES).alias("buckets")), "rows")
    blocks = max(8, -(-rows.count() // LN.BLOCK_ROWS))
    fitted = LN.fit(LN.counted(rows, MD.HASH_FEATURES, blocks), 4, MD.HASH_FEATURES, "sigmoid", n_blocks=blocks, tol=2e-3)
    path = scratch_path(spark, "model")
    fitted.save(path)
    targets = F.array(*[F.when(F.substring("type", i + 1, 1) == x[0], 0.0).otherwise(1.0) for i, x in enumerate(L.AXES)])
    keys = ch.select(F.monotonically_increasing_id().alias("id"), "person_id", "chunk_no", targets.alias("y"),
                     LN.hashed("tok", MD.HASH_FEATURES).alias("buckets"))
    keys = store(keys, "keys")                                   # ids are unique once written
    z = LN.Linear.load(spark, path).margins(LN.counted(keys.select("id", "y", "buckets"), MD.HASH_FEATURES, blocks))
    return z.join(keys.select("id", "person_id", "chunk_no"), "id").select(
        "person_id", "chunk_no", *[(F.col("z")[i] > 0).cast("int").alias(f"pred_{x}") for i, x in enumerate(names)],
        *[F.col("y")[i].cast("int").alias(f"target_{x}") for i, x in enumerate(names)])


@query("label_indexer", S.with_(S.AXES_CTE) + """
SELECT doc_id, type, CAST(dense_rank() OVER (ORDER BY type) - 1 AS INTEGER) AS label_alpha FROM axes""")
def label_indexer(spark, d):
    """Alphabetical label index through Spark ML (StringIndexer, alphabetAsc)."""
    a = V.axes(spark, d).select("doc_id", "type")
    m = StringIndexer(inputCol="type", outputCol="idx", stringOrderType="alphabetAsc").fit(a)
    return m.transform(a).select("doc_id", "type", F.col("idx").cast("int").alias("label_alpha"))


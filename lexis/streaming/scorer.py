"""Scoring of incoming text requests, batch or streaming.

One request = one row (request_id, text).  Everything a request needs stays
inside its row — clean, split into sentences, pack sentences into chunks of
at most ``budget`` tokens (the trailing chunk only with >= ``min_last``
tokens), score every chunk, average the axis probabilities, turn them into
tags and confidences — so the stream is a stateless projection: no state
store, no watermark, no shuffle.  The file source records consumed files in
the checkpoint, so each request is processed once, and a restarted query
resumes where it stopped.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from lexis.functions import labels as L
from lexis.functions import text as T
from lexis.operators import chunk as K
from lexis.operators import clean as C
from lexis.operators import scoring as SC

REQUEST_SCHEMA = Ty.StructType([Ty.StructField("request_id", Ty.LongType()),
                                Ty.StructField("text", Ty.StringType())])


def pack_text_chunks(sentences, budget: int = 1024, min_last: int = 10) -> Column:
    """Sentences -> chunk texts by token count (same rule as id packing)."""
    sized = F.transform(sentences, lambda s: F.struct(s.alias("t"), F.size(T.word_tokens(s)).alias("n")))
    init = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("ct"), F.lit(0).alias("cn"))

    def step(acc, x):
        fits = acc["cn"] + x["n"] <= budget
        return F.struct(F.when(fits, acc["done"]).otherwise(F.array_append(acc["done"], acc["ct"])).alias("done"),
                        F.when(fits, F.concat(acc["ct"], x["t"])).otherwise(x["t"]).alias("ct"),
                        F.when(fits, acc["cn"] + x["n"]).otherwise(x["n"]).alias("cn"))

    def fin(acc):
        return F.when(acc["cn"] >= min_last, F.array_append(acc["done"], acc["ct"])).otherwise(acc["done"])

    return F.aggregate(sized, init, step, fin)


def request_pipeline(df: DataFrame, id_col: str = "request_id", text_col: str = "text", budget: int = 1024,
                     min_last: int = 10, scorer=SC.rule_logits) -> DataFrame:
    chunks = pack_text_chunks(K.request_sentences_col(C.clean_request_col(F.col(text_col))), budget, min_last)
    probs = F.transform(chunks, lambda c: F.array(*[SC.sigmoid(lg) for lg in scorer(c)]))
    x = df.select(F.col(id_col).alias("request_id"), probs.alias("_p"))
    n = F.size("_p")
    sums = [F.aggregate("_p", F.lit(0.0), _add_at(i)) for i in range(4)]
    scores = [F.try_divide(s, n) * 100 for s in sums]
    y = x.select("request_id", n.alias("n_chunks"),
                 *[s.alias(f"score_{a.lower()}") for s, a in zip(scores, L.AXES)])
    return _labels_inline(y)


def _add_at(i: int):
    def f(acc, p):
        return acc + p[i]
    return f


def _labels_inline(y: DataFrame) -> DataFrame:
    """Tags, scores and confidences without a join (keeps the stream stateless)."""
    ps = [F.col(f"score_{ax.lower()}") / 100 for ax in L.AXES]
    cols = L.score_tags(*ps)
    tags, vals = cols[:4], cols[4:]
    out = y.select("request_id", "n_chunks", F.concat(*tags).alias("type_pred"),
                   *[v.alias(f"s_{ax.lower()}") for v, ax in zip(vals, L.AXES)])
    return out.select("*", *[L.confidence(f"s_{ax.lower()}").alias(f"conf_{ax.lower()}") for ax in L.AXES])


def write_requests(df: DataFrame, path: str, rows_per_file: int | None = None, mode: str = "overwrite") -> None:
    """Drop requests as JSON-lines files (the producer side), as many as the
    input has partitions, each of at most ``rows_per_file`` rows if given;
    ``mode='append'`` adds new files next to those already consumed."""
    w = df.select(F.col("request_id").cast("long"), "text").write.mode(mode)
    (w.option("maxRecordsPerFile", rows_per_file) if rows_per_file else w).json(path)


def stream_scores(spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str, max_files: int = 1000,
                  clean_source: str = "delete", **kw) -> None:
    """Run the request stream until every available file is consumed
    (``availableNow``), appending results as Parquet with exactly-once
    file-sink semantics.  A consumed request leaves the source once its batch is
    committed (``clean_source``: ``delete``, ``archive`` or ``off``; the files of the
    last batch go at the latest with the next run)."""
    src = spark.readStream.schema(REQUEST_SCHEMA).option("maxFilesPerTrigger", max_files) \
        .option("cleanSource", clean_source).json(in_dir)
    q = request_pipeline(src, **kw).writeStream.format("parquet").outputMode("append") \
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out_dir)
    q.awaitTermination()


# ---------------------------------------------------------------------------
# scoring with fitted Spark ML models (one pipeline, four axis heads)
# ---------------------------------------------------------------------------
def fit_axis_models(docs: DataFrame, text_col: str = "text", label_cols=("b_ie", "b_ns", "b_ft", "b_jp"),
                    num_features: int = 1 << 18, max_iter: int = 100):
    """One pipeline: word tokens -> hashed counts (no vocabulary) -> four
    logistic-regression heads, one per axis (bit 1 = second letter).  Features
    are computed once and kept on disk, row by row in the order of the texts, and every
    head is fitted on them."""
    from pyspark.ml import PipelineModel
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import HashingTF, RegexTokenizer
    stages = [RegexTokenizer(inputCol=text_col, outputCol="_tok", pattern=f"[{T.WORD}]{{2,}}", gaps=False),
              HashingTF(inputCol="_tok", outputCol="_cv", numFeatures=num_features)]
    data = docs.select(text_col, *[F.col(c).cast("double").alias(c) for c in label_cols])
    rows = PipelineModel(stages).transform(data).select("_cv", *label_cols).persist(StorageLevel.DISK_ONLY)
    try:
        for ax, lab in zip(L.AXES, label_cols):
            a = ax.lower()
            stages.append(LogisticRegression(featuresCol="_cv", labelCol=lab, maxIter=max_iter,
                                             predictionCol=f"_pred_{a}", probabilityCol=f"_prob_{a}",
                                             rawPredictionCol=f"_raw_{a}").fit(rows))
    finally:
        rows.unpersist()
    return PipelineModel(stages)


def score_requests_with_model(df: DataFrame, model, id_col: str = "request_id", text_col: str = "text",
                              budget: int = 1024, min_last: int = 10) -> DataFrame:
    """Requests -> chunks (one row each) -> model probabilities -> mean per
    request and axis -> tags.  The group of a request is its own chunks."""
    from pyspark.ml.functions import vector_to_array
    chunks = pack_text_chunks(K.request_sentences_col(C.clean_request_col(F.col(text_col))), budget, min_last)
    rows = df.select(F.col(id_col).alias("request_id"), F.posexplode_outer(chunks).alias("chunk_no", "text"))
    scored = model.transform(rows.where(F.col("text").isNotNull()))
    probs = scored.select("request_id", *[vector_to_array(f"_prob_{a.lower()}")[1].alias(f"p_{a.lower()}")
                                          for a in L.AXES])
    agg = probs.groupBy("request_id").agg(F.count(F.lit(1)).alias("n_chunks"),
                                          *[(F.avg(f"p_{a.lower()}") * 100).alias(f"score_{a.lower()}")
                                            for a in L.AXES])
    ids = df.select(F.col(id_col).alias("request_id")).distinct()          # a request without chunks has a row too; its text is not read for it
    y = ids.join(agg, "request_id", "left").withColumn("n_chunks", F.coalesce("n_chunks", F.lit(0)).cast("int"))
    return _labels_inline(y)


def stream_scores_with_model(spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str, model,
                             max_files: int = 1000, clean_source: str = "delete") -> None:
    """Streaming variant: every micro-batch is scored as a batch (the model
    works on chunk rows) and written to ``out_dir/epoch=<id>`` with overwrite,
    so a micro-batch replayed after a failure replaces its own output.  Consumed
    requests leave the source as in ``stream_scores``."""
    import os

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        score_requests_with_model(batch, model).write.mode("overwrite") \
            .parquet(os.path.join(out_dir, f"epoch={epoch_id}"))

    src = spark.readStream.schema(REQUEST_SCHEMA).option("maxFilesPerTrigger", max_files) \
        .option("cleanSource", clean_source).json(in_dir)
    q = src.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint) \
        .trigger(availableNow=True).start()
    q.awaitTermination()

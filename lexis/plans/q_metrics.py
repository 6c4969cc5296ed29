"""Registered evaluation / scoring queries (EVL-1..7, EVL-10, SCR-1, ARG-1,
LBL-10/11, SNK-2, TOP-2, MOD-5).

Predictions come from real operators over the driver tables: the per-axis
baseline scorer over the labelled documents, and exact k-NN over the
embeddings with a stratified seeded hold-out."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexis.functions import labels as L
from lexis.operators import metrics as M
from lexis.operators import neighbors as N
from lexis.operators import scoring as SC
from lexis.operators import split as SP
from lexis.plans import sqlviews as S
from lexis.plans.registry import query
from lexis.sources import tables as V

# --------------------------------------------------------------------------
# SQL building blocks
# --------------------------------------------------------------------------


def _logits_sql(t: str) -> list[str]:
    letters = rf"length(regexp_replace({t}, '[^\p{{L}}]', '', 'g'))"
    ascii_l = f"length(regexp_replace({t}, '[^a-zA-Z]', '', 'g'))"
    words = f"len(regexp_extract_all({t}, '{S.W}+'))"
    return [f"(({ascii_l}) / greatest({letters}, 1) - 0.9) * 20.0",
            f"((length({t}) - length(replace({t}, '!', ''))) - 3.0) / 2.0",
            f"({letters}) / greatest({words}, 1) - 5.0",
            f"(length({t}) - 2000.0) / 500.0"]


def _scored_sql(src: str, key: str, extra: str = "") -> str:
    lg = _logits_sql("text")
    cols = ", ".join(f"{x} AS logit_{a.lower()}" for x, a in zip(lg, L.AXES))
    return f"SELECT {key}{extra}, {cols} FROM {src}"


def _probs_sql(src: str, key: str, extra: str = "") -> str:
    ps = ", ".join(f"1.0 / (1.0 + exp(-logit_{a.lower()})) AS p_{a.lower()}" for a in L.AXES)
    return f"SELECT {key}{extra}, {ps} FROM ({src})"


_AX_CTE = S.with_(S.AXES_CTE, f"""
lg AS ({_scored_sql('axes', 'doc_id', ', b_ie, b_ns, b_ft, b_jp')}),
pr AS (SELECT *, {', '.join(f'1.0 / (1.0 + exp(-logit_{a.lower()})) AS p_{a.lower()}' for a in L.AXES)} FROM lg),
pd AS (SELECT *, {', '.join(f'CAST(p_{a.lower()} >= 0.5 AS INTEGER) AS pred_{a.lower()}' for a in L.AXES)} FROM pr),
lng AS ({' UNION ALL '.join(f"SELECT doc_id, '{a}' AS axis, pred_{a.lower()} AS pred, b_{a.lower()} AS target FROM pd"
                             for a in L.AXES)}),
rc AS (SELECT doc_id, CAST((pred_ie * 8 + pred_ns * 4 + pred_ft * 2 + pred_jp + 8) % 16 AS INTEGER) AS pred_code,
              CAST((b_ie * 8 + b_ns * 4 + b_ft * 2 + b_jp + 8) % 16 AS INTEGER) AS actual_code FROM pd)""")


def _axis_scored(spark, d):
    a = V.axes(spark, d).select("doc_id", "text", "b_ie", "b_ns", "b_ft", "b_jp")
    return SC.score_axes(a, "text")


def _axis_long(spark, d):
    return SC.axis_long(_axis_scored(spark, d), "doc_id", ["b_ie", "b_ns", "b_ft", "b_jp"])


_PRED = [f"pred_{a.lower()}" for a in L.AXES]
_BITS = [f"b_{a.lower()}" for a in L.AXES]


def _recombined(spark, d):
    return M.recombined(_axis_scored(spark, d), "doc_id", _PRED, _BITS)


@query("axis_recombine", _AX_CTE + "SELECT doc_id, pred_code, actual_code FROM rc")
def axis_recombine(spark, d):
    return _recombined(spark, d)


def _grid_sql(src: str, r: str, c: str, n: int = 16) -> str:
    return f"""
SELECT CAST(g // {n} AS INTEGER) AS row, CAST(g % {n} AS INTEGER) AS col, CAST(count(x.{r}) AS BIGINT) AS n
FROM range({n * n}) t(g) LEFT JOIN {src} x ON x.{r} = g // {n} AND x.{c} = g % {n}
GROUP BY g"""


@query("confusion_long", _AX_CTE + _grid_sql("rc", "pred_code", "actual_code"))
def confusion_long(spark, d):
    """Rows = predicted, columns = actual (16 x 16, zero-filled)."""
    return M.confusion_long(_recombined(spark, d), "pred_code", "actual_code", 16, rows="pred")


@query("confusion_actual_rows", _AX_CTE + _grid_sql("rc", "actual_code", "pred_code"))
def confusion_actual_rows(spark, d):
    """Transposed orientation: rows = actual."""
    return M.confusion_long(_recombined(spark, d), "pred_code", "actual_code", 16, rows="actual")


@query("confusion_wide", _AX_CTE + ", g AS (" + _grid_sql("rc", "pred_code", "actual_code") + ")\n"
       + "SELECT row, " + ", ".join(f"CAST(sum(CASE WHEN col = {i} THEN n END) AS BIGINT) AS c{i}" for i in range(16))
       + " FROM g GROUP BY row")
def confusion_wide(spark, d):
    return M.confusion_wide(M.confusion_long(_recombined(spark, d), "pred_code", "actual_code", 16))


@query("confusion_soft", _AX_CTE + """,
cp AS (SELECT doc_id, CAST((b_ie * 8 + b_ns * 4 + b_ft * 2 + b_jp + 8) % 16 AS INTEGER) AS actual,
              list_transform(range(16), lambda c:
                 (CASE WHEN (c >> 3) & 1 = 1 THEN p_ie ELSE 1.0 - p_ie END) *
                 (CASE WHEN (c >> 2) & 1 = 1 THEN p_ns ELSE 1.0 - p_ns END) *
                 (CASE WHEN (c >> 1) & 1 = 1 THEN p_ft ELSE 1.0 - p_ft END) *
                 (CASE WHEN c & 1 = 1 THEN p_jp ELSE 1.0 - p_jp END)) AS probs FROM pd),
ex AS (SELECT actual, CAST((unnest(range(16)) + 8) % 16 AS INTEGER) AS class, unnest(probs) AS p FROM cp)
SELECT actual, class, round(sum(p), 6) AS p_sum FROM ex GROUP BY actual, class""")
def confusion_soft(spark, d):
    """Soft matrix: per actual class (code B), the summed probability of every
    class (code B); class probabilities are products of axis probabilities."""
    s = _axis_scored(spark, d)
    s = s.select(L.flip(L.code_from_bits("b_ie", "b_ns", "b_ft", "b_jp")).alias("actual"),
                 SC.class_probs(s).alias("probs"))
    x = M.confusion_soft(s, "actual", "probs")
    return x.select("actual", L.flip(F.col("class")).alias("class"), F.round("p_sum", 6).alias("p_sum"))


@query("argmax_class", _AX_CTE + """,
cp AS (SELECT doc_id, list_transform(range(16), lambda c:
                 (CASE WHEN (c >> 3) & 1 = 1 THEN p_ie ELSE 1.0 - p_ie END) *
                 (CASE WHEN (c >> 2) & 1 = 1 THEN p_ns ELSE 1.0 - p_ns END) *
                 (CASE WHEN (c >> 1) & 1 = 1 THEN p_ft ELSE 1.0 - p_ft END) *
                 (CASE WHEN c & 1 = 1 THEN p_jp ELSE 1.0 - p_jp END)) AS probs FROM pd)
SELECT doc_id, CAST(list_position(probs, list_max(probs)) - 1 AS INTEGER) AS class, round(list_max(probs), 6) AS p
FROM cp""")
def argmax_class(spark, d):
    """Arg-max class (code A) of the 16 class probabilities; first wins on ties."""
    s = _axis_scored(spark, d)
    s = s.select("doc_id", SC.class_probs(s).alias("probs"))
    return s.select("doc_id", SC.argmax_first("probs").alias("class"), F.round(F.array_max("probs"), 6).alias("p"))


_F1_SQL = """
SELECT axis, tp, fp, fn, tn,
       round(CASE WHEN tp + fp = 0 THEN NULL ELSE tp / (tp + fp) END, 6) AS precision,
       round(CASE WHEN tp + fn = 0 THEN NULL ELSE tp / (tp + fn) END, 6) AS recall,
       round(CASE WHEN tp + fp = 0 OR tp + fn = 0 OR tp = 0 THEN NULL
                  ELSE 2 * (tp / (tp + fp)) * (tp / (tp + fn)) / ((tp / (tp + fp)) + (tp / (tp + fn))) END, 6) AS f1,
       round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END, 6) AS f1_binary,
       round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy
FROM (SELECT axis, count(*) FILTER (WHERE pred = 1 AND target = 1) AS tp, count(*) FILTER (WHERE pred = 1 AND target = 0) AS fp,
             count(*) FILTER (WHERE pred = 0 AND target = 1) AS fn, count(*) FILTER (WHERE pred = 0 AND target = 0) AS tn
      FROM lng GROUP BY axis)"""


@query("axis_f1", _AX_CTE + _F1_SQL)
def axis_f1(spark, d):
    """tp/fp/fn/tn, precision, recall, F1 (NULL when undefined), binary F1
    (0 when undefined) and accuracy per axis."""
    c = M.binary_counts(_axis_long(spark, d), "pred", "target", ["axis"])
    out = c.select("axis", "tp", "fp", "fn", "tn", *M.f1_columns())
    return out.select("axis", "tp", "fp", "fn", "tn",
                      *[F.round(x, 6).alias(x) for x in ("precision", "recall", "f1", "f1_binary", "accuracy")])


def _macro_sql(src: str, p: str, a: str, grp: str) -> str:
    return f"""(SELECT {grp} AS scope, round(avg(f1), 6) AS macro_f1, count(*) AS n_classes FROM (
  SELECT s.{grp}, s.cls,
         coalesce(2.0 * count(*) FILTER (WHERE x.{p} = s.cls AND x.{a} = s.cls)
                  / nullif(count(*) FILTER (WHERE x.{p} = s.cls) + count(*) FILTER (WHERE x.{a} = s.cls), 0), 0.0) AS f1
  FROM (SELECT DISTINCT {grp}, {p} AS cls FROM {src} UNION SELECT DISTINCT {grp}, {a} FROM {src}) s
  JOIN {src} x ON x.{grp} = s.{grp} GROUP BY s.{grp}, s.cls) GROUP BY {grp})"""


@query("macro_f1", _AX_CTE + """,
rc2 AS (SELECT 'ALL' AS axis, pred_code AS pred, actual_code AS target FROM rc)
""" + _macro_sql("lng", "pred", "target", "axis") + " UNION ALL " + _macro_sql("rc2", "pred", "target", "axis"))
def macro_f1(spark, d):
    """Macro F1 per axis (2 classes) and over the recombined 16-class codes
    ('ALL'), averaged over the union of seen labels."""
    out = M.macro_f1_of_cells(M.scope_cells(_axis_scored(spark, d), _PRED, _BITS), ["scope"])
    return out.select("scope", F.round("macro_f1", 6).alias("macro_f1"), "n_classes")


# --------------------------------------------------------------------------
# k-NN over embeddings (MOD-5 / TOP-2 / JN-6)
# --------------------------------------------------------------------------
_KNN_CTE = "WITH " + S.stratified_sizes_cte("sz", "embeddings", "label") + """,
e AS (
  SELECT vec_id, embedding, label,
         row_number() OVER (PARTITION BY label ORDER BY md5(CAST(vec_id AS VARCHAR) || ':1'), vec_id) - 1 AS rk
  FROM embeddings),
sp AS (SELECT e.vec_id, e.embedding, e.label, e.rk < sz.n_test AS is_test FROM e JOIN sz ON e.label = sz.label),
pairs AS (SELECT q.vec_id AS query_id, t.vec_id AS neighbor_id,
                 sqrt(list_sum(list_transform(range(1, len(q.embedding) + 1), lambda i:
                      (CAST(q.embedding[i] AS DOUBLE) - CAST(t.embedding[i] AS DOUBLE)) *
                      (CAST(q.embedding[i] AS DOUBLE) - CAST(t.embedding[i] AS DOUBLE))))) AS dist
          FROM sp q JOIN sp t ON q.is_test AND NOT t.is_test),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY dist, neighbor_id) - 1 AS rank FROM pairs),
top AS (SELECT * FROM r WHERE rank < 2)
"""


def _knn(spark, d):
    v = V.vec(spark, d)
    side = SP.split_stratified(v.select("vec_id", "label"), "vec_id", "label", 0.15, 1).select("vec_id", "split")
    sp = v.join(side, "vec_id")                       # ids and labels are ranked, the vectors join the result
    test = sp.where("split = 'test'")
    train = sp.where("split = 'train'")
    return N.knn(train, test, "vec_id", "embedding", k=2), train


@query("knn_topk", _KNN_CTE + "SELECT query_id, CAST(rank AS INTEGER) AS rank, neighbor_id, round(dist, 6) AS dist FROM top")
def knn_topk(spark, d):
    nb, _ = _knn(spark, d)
    return nb.select("query_id", F.col("rank").cast("int").alias("rank"), "neighbor_id", F.round("dist", 6).alias("dist"))


_KNN_PRED_SQL = _KNN_CTE + """,
votes AS (SELECT t.query_id, s.label AS nl, count(*) AS v FROM top t JOIN sp s ON s.vec_id = t.neighbor_id
          GROUP BY t.query_id, s.label),
best AS (SELECT query_id, arg_min(nl, (-v, nl)) AS pred FROM votes GROUP BY query_id),
kp AS (SELECT b.query_id AS vec_id, b.pred, e.label FROM best b JOIN embeddings e ON e.vec_id = b.query_id)
"""


def _knn_pred(spark, d):
    nb, train = _knn(spark, d)
    pred = N.knn_predict(nb, train, "vec_id", "label")
    lab = V.vec(spark, d).select(F.col("vec_id").alias("query_id"), "label")
    return pred.join(lab, "query_id").select(F.col("query_id").alias("vec_id"), "pred", "label")


@query("knn_predict", _KNN_PRED_SQL + "SELECT vec_id, pred, label FROM kp")
def knn_predict(spark, d):
    """k = 2 majority vote, a 1-1 vote goes to the smaller label."""
    return _knn_pred(spark, d)


@query("confusion_knn", _KNN_PRED_SQL + _grid_sql("kp", "pred", "label", 10))
def confusion_knn(spark, d):
    return M.confusion_long(_knn_pred(spark, d), "pred", "label", 10, rows="pred")


@query("accuracy", _AX_CTE + """
SELECT axis AS model, round(avg(CAST(pred = target AS DOUBLE)) * 100, 6) AS accuracy_pct, count(*) AS n FROM lng GROUP BY axis
UNION ALL SELECT 'recombined', round(avg(CAST(pred_code = actual_code AS DOUBLE)) * 100, 6), count(*) FROM rc""")
def accuracy(spark, d):
    """Accuracy in % per axis model and for the recombined 16-class code."""
    out = M.accuracy_of_cells(M.scope_cells(_axis_scored(spark, d), _PRED, _BITS), ["scope"])
    model = F.when(F.col("scope") == "ALL", "recombined").otherwise(F.col("scope"))
    return out.select(model.alias("model"), F.round("accuracy_pct", 6).alias("accuracy_pct"), "n")


@query("accuracy_knn", _KNN_PRED_SQL + """
SELECT 'knn' AS model, round(avg(CAST(pred = label AS DOUBLE)) * 100, 6) AS accuracy_pct, count(*) AS n FROM kp""")
def accuracy_knn(spark, d):
    a = M.accuracy_pct(_knn_pred(spark, d), "pred", "label").withColumn("model", F.lit("knn"))
    return a.select("model", F.round("accuracy_pct", 6).alias("accuracy_pct"), "n")


# --------------------------------------------------------------------------
# chunk-averaged request scoring (SCR-1, LBL-10/11)
# --------------------------------------------------------------------------
def _person_chunks(spark, d):
    from lexis.plans.q_chunk import _pack_person
    return _pack_person(spark, d).select("person_id", "chunk_no", F.col("chunk").alias("text"))


def _score_sql() -> str:
    from lexis.plans.q_chunk import _PACK_PERSON_SQL
    lg = _logits_sql("text")
    cols = ", ".join(f"{x} AS logit_{a.lower()}" for x, a in zip(lg, L.AXES))
    return _PACK_PERSON_SQL + f""",
chunks AS (SELECT person_id, unnest(chunks) AS text FROM fin),
cl AS (SELECT person_id, {cols} FROM chunks),
sc AS (SELECT person_id, count(*) AS n_chunks, {', '.join(f'avg(1.0 / (1.0 + exp(-logit_{a.lower()}))) * 100 AS score_{a.lower()}' for a in L.AXES)}
       FROM cl GROUP BY person_id)
"""


@query("score_chunks", _score_sql() + "SELECT person_id, n_chunks, "
       + ", ".join(f"round(score_{a.lower()}, 6) AS score_{a.lower()}" for a in L.AXES) + " FROM sc")
def score_chunks(spark, d):
    """Mean axis probability (x100) over each person's packed chunks."""
    s = SC.chunk_scores(_person_chunks(spark, d), "person_id", "text")
    return s.select("person_id", "n_chunks", *[F.round(f"score_{a.lower()}", 6).alias(f"score_{a.lower()}")
                                               for a in L.AXES])


@query("score_to_label", _score_sql() + """,
tg AS (SELECT person_id,
  (CASE WHEN score_ie / 100 >= 0.5 THEN 'E' ELSE 'I' END) || (CASE WHEN score_ns / 100 >= 0.5 THEN 'N' ELSE 'S' END) ||
  (CASE WHEN score_ft / 100 >= 0.5 THEN 'F' ELSE 'T' END) || (CASE WHEN score_jp / 100 >= 0.5 THEN 'J' ELSE 'P' END) AS type_pred,
  100 - score_ie / 100 * 100 AS s_ie, score_ns / 100 * 100 AS s_ns, score_ft / 100 * 100 AS s_ft, score_jp / 100 * 100 AS s_jp
  FROM sc)
SELECT person_id, type_pred, round(s_ie, 6) AS s_ie, round(s_ns, 6) AS s_ns, round(s_ft, 6) AS s_ft, round(s_jp, 6) AS s_jp,
       round(greatest(s_ie, 100 - s_ie), 2) AS conf_ie, round(greatest(s_ns, 100 - s_ns), 2) AS conf_ns,
       round(greatest(s_ft, 100 - s_ft), 2) AS conf_ft, round(greatest(s_jp, 100 - s_jp), 2) AS conf_jp
FROM tg""")
def score_to_label(spark, d):
    """Tags + scores + confidences from the chunk-averaged scores."""
    s = SC.chunk_scores(_person_chunks(spark, d), "person_id", "text")
    t = SC.scores_to_labels(s, "person_id")
    return t.select("person_id", "type_pred", *[F.round(f"s_{a.lower()}", 6).alias(f"s_{a.lower()}") for a in L.AXES],
                    *[f"conf_{a.lower()}" for a in L.AXES])


# --------------------------------------------------------------------------
# request scoring, batch and stream (STR-1)
# --------------------------------------------------------------------------
def _request_cte() -> str:
    from lexis.plans.q_chunk import TOK
    lg = _logits_sql("text")
    cols = ", ".join(f"1.0 / (1.0 + exp(-({x}))) AS p_{a.lower()}" for x, a in zip(lg, L.AXES))
    scores = ", ".join(f"avg(p_{a.lower()}) * 100 AS score_{a.lower()}" for a in L.AXES)
    return S.with_(S.POSTS_CTE, recursive=True) + f""",
c AS (SELECT person_id, list_transform(string_split({S.clean_request('posts')}, '.'), lambda s: s || '.') AS parts
      FROM posts),
s AS (SELECT person_id, unnest(range(len(parts))) AS k, unnest(parts) AS t FROM c),
sz AS (SELECT person_id, k, t, len(regexp_extract_all(lower(t), '{TOK}')) AS n FROM s),
rec AS (
  SELECT person_id, -1 AS k, CAST([] AS VARCHAR[]) AS done, '' AS ct, 0 AS cn FROM c
  UNION ALL
  SELECT r.person_id, r.k + 1,
         CASE WHEN r.cn + x.n <= 1024 THEN r.done ELSE list_append(r.done, r.ct) END,
         CASE WHEN r.cn + x.n <= 1024 THEN r.ct || x.t ELSE x.t END,
         CASE WHEN r.cn + x.n <= 1024 THEN r.cn + x.n ELSE x.n END
  FROM rec r JOIN sz x ON x.person_id = r.person_id AND x.k = r.k + 1),
fin AS (SELECT person_id, CASE WHEN cn >= 10 THEN list_append(done, ct) ELSE done END AS chunks FROM rec
        QUALIFY k = max(k) OVER (PARTITION BY person_id)),
ch AS (SELECT person_id, unnest(chunks) AS text FROM fin),
cl AS (SELECT person_id, {cols} FROM ch),
sc0 AS (SELECT person_id, {scores} FROM cl GROUP BY person_id),
sc AS (SELECT f.person_id, CAST(len(f.chunks) AS INTEGER) AS n_chunks, sc0.score_ie, sc0.score_ns, sc0.score_ft, sc0.score_jp
       FROM fin f LEFT JOIN sc0 USING (person_id)),
tg AS (SELECT person_id, n_chunks,
  (CASE WHEN score_ie / 100 >= 0.5 THEN 'E' ELSE 'I' END) || (CASE WHEN score_ns / 100 >= 0.5 THEN 'N' ELSE 'S' END) ||
  (CASE WHEN score_ft / 100 >= 0.5 THEN 'F' ELSE 'T' END) || (CASE WHEN score_jp / 100 >= 0.5 THEN 'J' ELSE 'P' END) AS type_pred,
  100 - score_ie / 100 * 100 AS s_ie, score_ns / 100 * 100 AS s_ns, score_ft / 100 * 100 AS s_ft, score_jp / 100 * 100 AS s_jp
  FROM sc)
"""


def _request_sql() -> str:
    return _request_cte() + """SELECT person_id AS request_id, n_chunks, type_pred, round(s_ie, 6) AS s_ie, round(s_ns, 6) AS s_ns,
       round(s_ft, 6) AS s_ft, round(s_jp, 6) AS s_jp,
       round(greatest(s_ie, 100 - s_ie), 2) AS conf_ie, round(greatest(s_ns, 100 - s_ns), 2) AS conf_ns,
       round(greatest(s_ft, 100 - s_ft), 2) AS conf_ft, round(greatest(s_jp, 100 - s_jp), 2) AS conf_jp
FROM tg
"""


def _round_scores(df):
    return df.select("request_id", "n_chunks", "type_pred",
                     *[F.round(f"s_{a.lower()}", 6).alias(f"s_{a.lower()}") for a in L.AXES],
                     *[f"conf_{a.lower()}" for a in L.AXES])


def _requests(spark, d):
    return V.posts(spark, d).select(F.col("person_id").alias("request_id"), F.col("posts").alias("text"))


@query("score_requests", _request_sql())
def score_requests(spark, d):
    """Batch path of the request scorer: clean -> sentences -> token-budget
    chunks -> chunk scores -> mean per axis -> tags + confidences."""
    from lexis.streaming.scorer import request_pipeline
    return _round_scores(request_pipeline(_requests(spark, d)))


@query("stream_score", _request_sql())
def stream_score(spark, d):
    """Streaming path: requests dropped as files, consumed once by a file
    stream (availableNow) into a Parquet sink with a checkpoint; the sink is
    read back and must equal the batch path."""
    import os
    from lexis.session import scratch_path
    from lexis.streaming.scorer import stream_scores, write_requests
    base = scratch_path(spark, "stream")
    write_requests(_requests(spark, d), os.path.join(base, "in"))
    stream_scores(spark, os.path.join(base, "in"), os.path.join(base, "out"), os.path.join(base, "ckpt"))
    return _round_scores(spark.read.parquet(os.path.join(base, "out")))


def _axis_model(spark, d):
    """Fit the four axis heads on the labelled documents, persist and reload."""
    from pyspark.ml import PipelineModel
    from lexis.session import scratch_path
    from lexis.streaming.scorer import fit_axis_models
    m = fit_axis_models(V.axes(spark, d))
    path = scratch_path(spark, "axis-model")
    m.write().overwrite().save(path)
    return PipelineModel.load(path)


@query("score_requests_model")
def score_requests_model(spark, d):
    """Request scoring with fitted per-axis models (batch)."""
    from lexis.streaming.scorer import score_requests_with_model
    return _round_scores(score_requests_with_model(_requests(spark, d), _axis_model(spark, d)))


@query("stream_score_model")
def stream_score_model(spark, d):
    """Request scoring with fitted per-axis models as a stream (foreachBatch,
    idempotent per micro-batch)."""
    import os
    from lexis.session import scratch_path
    from lexis.streaming.scorer import stream_scores_with_model, write_requests
    base = scratch_path(spark, "stream-model")
    write_requests(_requests(spark, d), os.path.join(base, "in"))
    stream_scores_with_model(spark, os.path.join(base, "in"), os.path.join(base, "out"), os.path.join(base, "ckpt"),
                             _axis_model(spark, d))
    return _round_scores(spark.read.parquet(os.path.join(base, "out")).drop("epoch"))


@query("score_record", _request_cte() + """
SELECT person_id AS request_id, type_pred AS type,
       printf('%.2f', CASE WHEN s_ie > 50 THEN s_ie ELSE 100 - s_ie END) AS conf_ie,
       printf('%.2f', CASE WHEN s_ns > 50 THEN s_ns ELSE 100 - s_ns END) AS conf_ns,
       printf('%.2f', CASE WHEN s_ft > 50 THEN s_ft ELSE 100 - s_ft END) AS conf_ft,
       printf('%.2f', CASE WHEN s_jp > 50 THEN s_jp ELSE 100 - s_jp END) AS conf_jp
FROM tg""")
def score_record(spark, d):
    """Scoring record sink and response decode: each request's 8-line record
    (tag bits, scores) is written as JSON, read back and decoded into the
    type letters and two-decimal confidences."""
    import os
    from lexis.session import scratch_path
    from lexis.streaming.scorer import request_pipeline
    rec = request_pipeline(_requests(spark, d)).select("request_id", SC.record_text().alias("record"))
    path = scratch_path(spark, "records")
    rec.write.mode("overwrite").json(path)
    back = spark.read.schema("request_id long, record string").json(path)
    return back.select("request_id", *SC.decode_record("record"))

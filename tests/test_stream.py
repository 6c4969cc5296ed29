"""Request stream: consumed once, restartable from its checkpoint, equal to
the batch path."""

import os

from pyspark.sql import functions as F

from conftest import SF001
from lexis.session import scratch_path
from lexis.sources import tables as V
from lexis.streaming import scorer as ST


def test_stream_restart_exactly_once(spark):
    req = V.posts(spark, SF001).select(F.col("person_id").alias("request_id"), F.col("posts").alias("text"))
    first = req.where("request_id % 2 = 0")
    second = req.where("request_id % 2 = 1")
    base = scratch_path(spark, "stream-test")
    inp, out, ck = (os.path.join(base, x) for x in ("in", "out", "ckpt"))
    ST.write_requests(first.repartition(3), inp)
    ST.stream_scores(spark, inp, out, ck, max_files=1)
    n1 = spark.read.parquet(out).count()
    assert n1 == first.count()
    ST.write_requests(second.repartition(3), inp, mode="append")
    ST.stream_scores(spark, inp, out, ck, max_files=1)        # restart: only new files
    res = spark.read.parquet(out)
    assert res.count() == req.count()
    assert res.select("request_id").distinct().count() == req.count()
    batch = ST.request_pipeline(req)
    cols = ["request_id", "n_chunks", "type_pred", "s_ie", "s_ns", "s_ft", "s_jp"]
    assert sorted(map(tuple, res.select(*cols).collect())) == sorted(map(tuple, batch.select(*cols).collect()))


def requests_left(path, names, seconds=20):
    """Those of the files that are still there (the source deletes in the background)."""
    import time
    end = time.time() + seconds
    while True:
        left = [n for n in names if os.path.exists(os.path.join(path, n))]
        if not left or time.time() > end:
            return left
        time.sleep(0.2)


def test_consumed_requests_leave_the_source(spark):
    """Files go after their batch is committed; a run on the same checkpoint scores new files only."""
    req = V.posts(spark, SF001).select(F.col("person_id").alias("request_id"), F.col("posts").alias("text"))
    base = scratch_path(spark, "stream-clean")
    inp, out, ck = (os.path.join(base, x) for x in ("in", "out", "ckpt"))
    seen, scored = [], 0
    for part in range(3):
        new = req.where(F.col("request_id") % 3 == part)
        ST.write_requests(new.repartition(3), inp, mode="append")
        files = [n for n in os.listdir(inp) if n.startswith("part-") and n not in seen]
        ST.stream_scores(spark, inp, out, ck, max_files=1)
        scored += new.count()
        got = spark.read.parquet(out)
        assert got.count() == scored and got.select("request_id").distinct().count() == scored
        assert len(requests_left(inp, seen)) == 0                       # all of the runs before
        assert len(requests_left(inp, files, 5)) <= 1                   # of this run at most the last batch
        seen += files


def test_model_stream_equals_batch(spark):
    from lexis.plans.q_metrics import _axis_model
    model = _axis_model(spark, SF001)
    req = V.posts(spark, SF001).select(F.col("person_id").alias("request_id"), F.col("posts").alias("text"))
    base = scratch_path(spark, "stream-model-test")
    inp, out, ck = (os.path.join(base, x) for x in ("in", "out", "ckpt"))
    ST.write_requests(req.repartition(4), inp)
    ST.stream_scores_with_model(spark, inp, out, ck, model, max_files=1)
    cols = ["request_id", "n_chunks", "type_pred", "s_ie", "s_ns", "s_ft", "s_jp"]
    got = sorted(map(tuple, spark.read.parquet(out).select(*cols).collect()))
    want = sorted(map(tuple, ST.score_requests_with_model(req, model).select(*cols).collect()))
    assert len(got) == req.count()
    assert [g[:3] for g in got] == [w[:3] for w in want]
    for g, w in zip(got, want):
        assert all(abs(a - b) < 1e-9 for a, b in zip(g[3:], w[3:]) if a is not None)

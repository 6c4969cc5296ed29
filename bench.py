"""Benchmark the headline queries.

Runs each query at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS] (default 8), forcing full evaluation with the ``noop``
sink (no collect), and prints ONE JSON line:

  {"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "hist_before_after",     # flagship: person texts -> profile clean -> histograms
    "clean_profile_docs",    # 9-step regex pipeline over whole documents
    "clean_bow",             # bag-of-words clean with stop words + label stripping
    "clean_mask_post",       # per-post mask clean + usability filter
    "count_vectors",         # tokens -> counts -> alphabetical index (distributed)
    "tfidf_l2",              # df-limited vocabulary + smoothed, normalised TF-IDF
    "vocab_encode",          # corpus vocabulary + id encoding
    "pack_by_class",         # exact parallel per-class token packing
    "pack_by_person",        # 300-word packing per person
    "pack_request",          # per-request sentence packing
    "split_stratified",      # seeded stratified split (distributed ranks)
    "axis_f1",               # per-axis scores -> tp/fp/fn/tn/F1
    "confusion_long",        # recombined 16-class confusion grid
    "knn_predict",           # exact pruned k-NN over embeddings
    "score_requests",        # request scoring path (batch)
    "log_predictions",       # prediction logs written, read, parsed
    "model_logreg",          # features + stratified split + multinomial LR fit + predict
    "model_mlp_16",          # n-gram features + 16-way perceptron fit + soft confusion
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    os.environ.setdefault("PYSPARK_PYTHON", sys.executable)

    from lexis.plans.registry import queries
    from lexis.session import clean_scratch, get_session

    scratch = tempfile.mkdtemp(prefix="lexis-bench-")
    spark = get_session(f"local[{cpus}]", max(cpus, 8), app_name="lexis-bench", extra={
        "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
        "spark.sql.files.maxPartitionBytes": str(64 << 20),
        "spark.local.dir": scratch,
        "spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
    })
    qs = queries()
    # warm-up: JVM, Python workers, codegen caches
    qs["table_shape"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float | None] = {}
    failed: list[str] = []
    for name in HEADLINE:
        t0 = time.time()
        try:
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.time() - t0, 3)
        except Exception as e:  # noqa: BLE001 - record and keep measuring the others
            times[name] = None
            failed.append(f"{name}: {type(e).__name__}")
    total = round(sum(v for v in times.values() if v is not None), 3)
    out = {"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": times, "sf": sf,
           "cpus": cpus}
    if failed:
        out["failed"] = failed
    clean_scratch(spark)
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()

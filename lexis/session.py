"""Session construction and shared-storage helpers.

Scratch output (round trips, lineage cuts) always goes below the folder the
cluster names in ``spark.checkpoint.dir``.  Only when that setting is unset
*and* Spark runs in local mode (tests, benches) do we create one ourselves.
"""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "lexis", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; create a local one only in local mode."""
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="lexis-ckpt-")
    if sc.getCheckpointDir() is None or not sc.getCheckpointDir().startswith(d.rstrip("/")):
        sc.setCheckpointDir(d)
    return d


def ship_package(spark: SparkSession) -> None:
    """Give this package to the Python workers (once for each Spark context), so
    that functions of its modules also run where the repository is no folder of
    the workers' search path."""
    sc = spark.sparkContext
    if getattr(sc, "_lexis_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    at = os.path.join(tempfile.mkdtemp(prefix="lexis-zip-"), "lexis.zip")
    with zipfile.ZipFile(at, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    path = os.path.join(folder, n)
                    z.write(path, os.path.join("lexis", os.path.relpath(path, root)))
    sc.addPyFile(at)
    sc._lexis_shipped = True


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint dir."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "lexis-scratch", spark.sparkContext.applicationId, f"{name}-{uuid.uuid4().hex[:12]}")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss); never a local checkpoint."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def store(df: DataFrame, name: str = "table", compression: str = "snappy", row_group: int | None = None) -> DataFrame:
    """``df`` written once below the shared folder and read back: lineage ends there
    and nothing is computed twice.  ``row_group``: bytes of the files' row groups, for
    rows so large that a task should read few at once."""
    path = scratch_path(df.sparkSession, name)
    out = df.write.option("compression", compression)
    (out.option("parquet.block.size", row_group) if row_group else out).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unstore(df: DataFrame) -> None:
    """Delete a table that ``store`` wrote and that nothing will read any more."""
    sc = df.sparkSession.sparkContext
    for at in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = sc._jvm.org.apache.hadoop.fs.Path(at)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def let_go(spark: SparkSession) -> None:
    """Free the shuffle files of finished jobs: Spark removes them once the driver's garbage is collected."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def clean_scratch(spark: SparkSession) -> None:
    """Delete everything below ``lexis-scratch`` of the shared folder that this
    application wrote.  Call it when the results are consumed: queries that
    write and read back return frames over these files."""
    sc = spark.sparkContext
    base = os.path.join(ensure_checkpoint_dir(spark), "lexis-scratch", sc.applicationId)
    path = sc._jvm.org.apache.hadoop.fs.Path(base)
    path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)

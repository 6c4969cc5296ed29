import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from lexis.session import get_session
    d = tempfile.mkdtemp(prefix="lexis-test-")
    s = get_session("local[*]", 8, app_name="lexis-tests", extra={
        "spark.driver.memory": "8g",          # one JVM runs all tests; forests of 200 trees need more than the default 1 GB
        "spark.local.dir": d, "spark.checkpoint.dir": os.path.join(d, "ckpt")})
    yield s
    s.stop()


@pytest.fixture(scope="module", autouse=True)
def tidy(request):
    """Nothing that a module cached or stored outlives it."""
    yield
    from pyspark.sql import SparkSession
    s = SparkSession.getActiveSession()
    if s is not None:
        import gc
        from lexis.session import clean_scratch
        s.catalog.clearCache()
        clean_scratch(s)
        gc.collect()
        s.sparkContext._jvm.System.gc()


def one(spark, col, value, name="x"):
    """Evaluate a Column function on a one-row DataFrame holding ``value``."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(value,)], f"{name} string")
    return df.select(col(F.col(name)).alias("r")).first()["r"]

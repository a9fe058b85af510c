import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[*]")
        .appName("hopscope-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="hopscope-test-ckpt-"))
    yield s


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="hopscope-test-")


def edges_df(spark, pairs):
    return spark.createDataFrame([(str(a), str(b)) for a, b in pairs], "src string, dst string")


def rows(df, cols=("source", "vertex", "dist")):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())

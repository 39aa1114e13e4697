import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master("local[4]").appName("strivelake-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getConf().get("spark.checkpoint.dir", None):
        # only when the environment names no shared checkpoint folder
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="strivelake-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture
def tmp_dir(spark):
    from strivelake.session import scratch_path
    return scratch_path(spark, "test")

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from aerostar.session import apply_defaults
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    apply_defaults(s)
    if s.sparkContext.getCheckpointDir() is None:
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="aerostar-test-ckpt-"))
    yield s


@pytest.fixture(scope="session")
def wh(spark):
    from aerostar.sources.star import derive_star
    return derive_star(spark, SMALL)


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="aerostar-test-")

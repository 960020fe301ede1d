import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    scratch = tempfile.mkdtemp(prefix="wiretable-tests-")
    s = (SparkSession.builder.master("local[*]")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    # Tests run locally: set a checkpoint folder only because none is configured.
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(f"{scratch}/checkpoints")
    yield s


@pytest.fixture
def scratch():
    return tempfile.mkdtemp(prefix="wiretable-test-")

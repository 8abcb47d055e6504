import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from voltrail.session import SCALE_CONF
    b = SparkSession.builder.master("local[4]").appName("voltrail-tests")
    for k, v in SCALE_CONF.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", "4")
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    # Tests run without a cluster-provided checkpoint folder: set a local one.
    if not s.conf.get("spark.checkpoint.dir", None):
        d = tempfile.mkdtemp(prefix="voltrail-test-ckpt-")
        s.conf.set("spark.checkpoint.dir", d)
        s.sparkContext.setCheckpointDir(d)
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="voltrail-test-")

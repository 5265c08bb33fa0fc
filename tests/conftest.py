import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tidylake.session import configure

    builder = (SparkSession.builder.master("local[*]")
               .appName("tidylake-tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.ui.enabled", "false"))
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    if not (s.conf.get("spark.checkpoint.dir", None) or s.sparkContext.getCheckpointDir()):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidylake-test-ckpt-"))
    configure(s)
    yield s


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)


def rows(df, order=None):
    """Collected rows as tuples, sorted for order-free comparison."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=repr) if order is None else out

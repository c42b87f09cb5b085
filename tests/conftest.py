import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from pricelens.session import DEFAULT_CONF, ensure_checkpoint_dir
    b = SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    # Tests set their own checkpoint folder only when the session names none.
    ensure_checkpoint_dir(s, fallback=tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    yield s


@pytest.fixture(scope="session")
def scratch():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")

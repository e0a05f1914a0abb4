import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tarmac.session import BASE_CONF

    ckpt = tempfile.mkdtemp(prefix="tarmac-test-ckpt-")
    b = SparkSession.builder.master("local[*]").appName("tarmac-tests")
    conf = dict(BASE_CONF)
    conf.update({"spark.sql.shuffle.partitions": "8", "spark.checkpoint.dir": ckpt,
                 "spark.driver.memory": "6g"})
    for k, v in conf.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    from tarmac.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="tarmac-test-")

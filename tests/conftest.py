import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from marketflow.session import DEFAULT_CONF, shared_dir
    builder = (SparkSession.builder.master("local[*]").appName("marketflow-tests")
               .config("spark.sql.shuffle.partitions", "8"))
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    shared_dir(session)
    yield session


@pytest.fixture()
def scratch(spark):
    from marketflow.session import scratch_path

    def make(name="t"):
        return scratch_path(spark, name)
    return make

import os
import sys
import uuid

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tomewise.session import BASE_CONF, checkpoint_dir
    from tomewise.sources.datasets import STAGE_ROOT_CONF

    b = SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    # tests write their stages under a fresh root of the shared folder
    s.conf.set(STAGE_ROOT_CONF, f"{checkpoint_dir(s)}/tests-{uuid.uuid4().hex}")
    yield s


@pytest.fixture()
def scratch(spark):
    from tomewise.session import checkpoint_dir
    return f"{checkpoint_dir(spark)}/test-scratch/{uuid.uuid4().hex}"

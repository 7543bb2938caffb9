import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from penstock.session import RECOMMENDED  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = SparkSession.builder.master("local[8]").appName("penstock-tests")
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    session = (
        builder.config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("PENSTOCK_SF_DIR", "/root/testdata/sf0.001")

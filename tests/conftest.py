import tempfile

import pytest
from pyspark.sql import SparkSession

from wakeline.session import RUNTIME_CONF, STATIC_CONF


@pytest.fixture(scope="session")
def spark():
    builder = SparkSession.builder.master("local[4]").appName("wakeline-tests")
    for key, value in {**STATIC_CONF, **RUNTIME_CONF}.items():
        builder = builder.config(key, value)
    session = (
        builder.config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()

import os
import sys

import pytest

os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, HERE)
os.environ["PYTHONPATH"] = os.pathsep.join([HERE, os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def sf():
    return SF

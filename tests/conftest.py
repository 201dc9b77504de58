from __future__ import annotations

import os
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tiffin.session import configure

    session = (
        SparkSession.builder.master("local[8]")
        .appName("tiffin-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield configure(session)
    session.stop()


@pytest.fixture(scope="module", autouse=True)
def _send_test_functions(request):
    """Functions of a test module travel to the tasks with their code."""
    cloudpickle.register_pickle_by_value(request.module)
    yield
    cloudpickle.unregister_pickle_by_value(request.module)


@pytest.fixture(scope="session")
def sf_dir():
    return SF

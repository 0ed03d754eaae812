import os
import sys
import uuid

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

from gridclimate.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("shared")
    session = build_session("tests", "local[4]", **{
        "spark.checkpoint.dir": f"{folder}/checkpoint", "spark.sql.warehouse.dir": f"{folder}/warehouse",
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture
def shared(spark, tmp_path):
    """A new folder under the cluster's shared one, or a test folder where none is named."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    return f"{base}/test-{uuid.uuid4().hex}" if base else str(tmp_path)

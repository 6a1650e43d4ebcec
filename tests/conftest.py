import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import build_session  # noqa: E402

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tidemark-tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.sql.maxMetadataStringLength": "10000",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-", dir="/tmp"),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    path = f"{TESTDATA}/sf0.01"
    if not os.path.isdir(path):
        pytest.skip("sample tables are not here")
    return path

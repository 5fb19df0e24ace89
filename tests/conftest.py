import os
import sys
from pathlib import Path

import pytest

HERE = Path(__file__).resolve().parent
PATHS = [str(HERE.parent), str(HERE)]
sys.path[:0] = PATHS
os.environ["PYTHONPATH"] = os.pathsep.join(PATHS)  # for Spark's Python workers

from tuplefeed.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.sql.maxMetadataStringLength": "10000",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR

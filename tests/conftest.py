import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from marketspark.session import build_session, clear_scratch  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="spark-"),
    })
    session.sparkContext.setLogLevel("OFF")
    yield session
    clear_scratch(session)
    session.stop()

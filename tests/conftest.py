from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from tideline.session import build_session, stream_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tideline-tests", "local[8]", {
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def streams(spark):
    session = stream_session(spark)
    session.conf.set("spark.sql.shuffle.partitions", "2")
    return session


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)

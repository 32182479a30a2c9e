from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from marketspark.session import build_session  # noqa: E402
from marketspark.sources.tables import Layout  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("marketspark-tests", "local[4]", {
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "4",
        "spark.default.parallelism": "4",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.maxMetadataStringLength": "4000",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lake(tmp_path):
    return Layout(str(tmp_path / "lake"))

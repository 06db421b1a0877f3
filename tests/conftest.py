from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from velotide.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "velotide-tests",
        "local[8]",
        {"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def conf(spark):
    """Set SQL settings for one test."""
    before = {}

    def put(**settings):
        for name, value in settings.items():
            key = "spark.sql." + name.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield put
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)

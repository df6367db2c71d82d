from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from cartpath import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        spark__ui__enabled="false",
        spark__sql__warehouse__dir=str(base / "warehouse"),
        spark__checkpoint__dir=str(base / "checkpoint"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def schema(spark, tmp_path):
    """A new catalog schema in its own folder."""
    name = f"t_{tmp_path.name}_{abs(hash(str(tmp_path))) % 10**8}".replace("-", "_").replace("[", "_").replace("]", "_")
    spark.sql(f"CREATE SCHEMA {name} LOCATION '{tmp_path / 'schema'}'")
    yield name
    spark.sql(f"DROP SCHEMA {name} CASCADE")

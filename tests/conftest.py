from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from weir.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
        spark__sql__streaming__stateStore__stateSchemaCheck="true",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Build a frame of text columns from dicts."""

    def build(rows, columns=None):
        columns = columns or list(dict.fromkeys(name for row in rows for name in row))
        schema = ", ".join(f"`{name}` string" for name in columns)
        return spark.createDataFrame([tuple(row.get(name) for name in columns) for row in rows], schema)

    return build

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from reclake.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "reclake-tests", "local[*]",
        spark__sql__shuffle__partitions="8", spark__ui__showConsoleProgress="false", spark__driver__memory="6g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df):
    """Rows of a frame as sorted tuples."""
    return sorted((tuple(row) for row in df.collect()), key=str)

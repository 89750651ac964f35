from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from skillweave.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf() -> str:
    return "/root/testdata/sf0.001"


def rows(df, *columns):
    """Rows as tuples, in any order."""
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)

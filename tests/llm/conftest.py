from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def engine(spark):
    """The test session, with the package on the path of its Python workers."""
    from mapledger.llm.common import importable

    return importable(spark)


def _rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


@pytest.fixture(scope="session")
def rows():
    return _rows

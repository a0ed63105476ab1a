from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import odd_rows  # noqa: E402


@pytest.fixture(scope="session")
def odd(spark):
    return odd_rows.odd(spark).cache()


@pytest.fixture(scope="session")
def none(spark):
    return odd_rows.empty(spark)

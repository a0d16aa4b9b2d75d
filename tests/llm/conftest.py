import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[2]
sys.path[:0] = [str(ROOT), str(ROOT / "tests"), str(ROOT / "tests" / "llm")]

from corpus_fixtures import DOCS, odd_rows  # noqa: E402


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCS)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)

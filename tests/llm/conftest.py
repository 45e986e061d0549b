import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from llm_data import odd_documents  # noqa: E402


@pytest.fixture(scope="session")
def odd(spark):
    return odd_documents(spark).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return odd_documents(spark).limit(0)

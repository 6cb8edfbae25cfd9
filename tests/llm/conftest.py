import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

from llm_rows import frame, hard_rows  # noqa: E402

from lakeloom.llm.rows import ship  # noqa: E402


@pytest.fixture(scope="session")
def hard(spark):
    ship(spark)
    return hard_rows()


@pytest.fixture(scope="session")
def docs(spark, hard):
    return frame(spark, hard)


@pytest.fixture(scope="session")
def none(spark):
    ship(spark)
    return frame(spark, [])

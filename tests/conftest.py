import sys
import tempfile
import uuid
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path[:0] = [str(Path(__file__).parent.parent), str(Path(__file__).parent)]

from lakeloom.plans.lakehouse import Lakehouse  # noqa: E402
from lakeloom.session import tune  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", f"{scratch}/shared")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield tune(session)
    session.stop()


@pytest.fixture
def lakehouse(spark, tmp_path):
    """An empty lakehouse with schemas of its own."""
    tag = uuid.uuid4().hex[:8]
    lake = Lakehouse(str(tmp_path), f"silver_{tag}", f"gold_{tag}", f"etl_{tag}")
    lake.create_schemas(spark)
    return lake


@pytest.fixture
def rows(spark):
    """Collected rows as sorted tuples."""

    def collect(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)

    return collect

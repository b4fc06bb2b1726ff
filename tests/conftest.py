import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(Path(__file__).resolve().parent)]

from callweave.operators.skew import HOT_ROWS, HOT_ROWS_SETTING  # noqa: E402
from callweave.session import builder  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        builder("tests").master("local[8]").config("spark.sql.shuffle.partitions", "2")
        .config("spark.default.parallelism", "2")
        .config("spark.driver.memory", "4g").config("spark.ui.enabled", "false").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(params=["whole", "sliced"])
def key_size(request, spark):
    """Run a test as is, and with every key of three rows or more taken as large."""
    if request.param == "sliced":
        spark.conf.set(HOT_ROWS_SETTING, "2")
    yield request.param
    spark.conf.set(HOT_ROWS_SETTING, str(HOT_ROWS))

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parent.parent)]

from fieldgauge import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    build = SparkSession.builder.master("local[8]").appName("tests")
    for key, value in session.DEFAULTS.items():
        build = build.config(key, value)
    made = (
        build.config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    made.sparkContext.setLogLevel("ERROR")
    yield session.prepared(made)
    made.stop()

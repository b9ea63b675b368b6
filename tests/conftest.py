from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

from shelfmark.session import DEFAULTS


def local_session() -> SparkSession:
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("shelfmark-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "4")
    )
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    return local_session()

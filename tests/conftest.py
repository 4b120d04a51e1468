from __future__ import annotations

import pytest
from pyspark.sql import SparkSession

from tidemark.session import SETTINGS


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "3g")
    for k, v in SETTINGS.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}").config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()

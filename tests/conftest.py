from __future__ import annotations

import os
import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from corpusmill.shipping import ship

    work = tempfile.mkdtemp(prefix="spark-")
    session = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g")
        .config("spark.sql.warehouse.dir", work).config("spark.checkpoint.dir", f"{work}/shared").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield ship(session)
    session.stop()


@pytest.fixture(scope="session")
def data():
    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("no test tables here")
    return folder

import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

DATA = os.environ.get("FAROL_TEST_DATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = (SparkSession.builder.master("local[8]").appName("farol-tests")
               .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC")
               .config("spark.driver.memory", "8g").config("spark.checkpoint.dir", str(base / "shared"))
               .config("spark.sql.warehouse.dir", str(base / "warehouse")).getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return f"{DATA}/sf0.001"


@pytest.fixture(scope="session")
def medium():
    return f"{DATA}/sf0.01"

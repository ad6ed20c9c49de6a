import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    settings = {"spark.sql.shuffle.partitions": "3", "spark.driver.memory": "3g", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.session.timeZone": "UTC", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tests-")}
    session = SparkSession.builder.master("local[4]").config(map=settings).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    conf = {"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.sql.session.timeZone": "UTC", "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false"}
    s = SparkSession.builder.master("local[4]").config(map=conf).getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    return s

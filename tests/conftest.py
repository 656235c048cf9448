import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    scratch = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    s = (SparkSession.builder.master("local[8]").appName("reelspark-tests")
         .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "6g")
         .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
         .config("spark.checkpoint.dir", f"{scratch}/checkpoint")
         .config("spark.local.dir", scratch).getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    base = tempfile.mkdtemp(prefix="spark-")
    conf = {
        "spark.master": "local[8]", "spark.ui.enabled": "false", "spark.driver.memory": "6g", "spark.sql.shuffle.partitions": "8", "spark.sql.session.timeZone": "UTC",
        "spark.checkpoint.dir": f"{base}/checkpoint", "spark.sql.warehouse.dir": f"{base}/warehouse", "spark.local.dir": f"{base}/local",
        "spark.driver.extraJavaOptions": f"-Dderby.stream.error.file={base}/derby.log",
    }
    session = SparkSession.builder.config(map=conf).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL

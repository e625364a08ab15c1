import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")
DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from bookmill.session import CONF

    s = (
        SparkSession.builder.master("local[4]")
        .config(
            map=CONF
            | {
                "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
                "spark.ui.showConsoleProgress": "false"
            }
        )
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture(scope="session")
def data():
    return DATA

import os
import sys
import tempfile

import pytest

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, HERE)
os.environ["PYTHONPATH"] = os.pathsep.join([HERE, *filter(None, [os.environ.get("PYTHONPATH")])])


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").config("spark.checkpoint.dir", "file://" + tempfile.mkdtemp(prefix="spark-")).config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="spark-")).getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    return s

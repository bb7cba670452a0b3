import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = (SparkSession.builder.master("local[4]").appName("provlake-tests").config("spark.sql.shuffle.partitions", "4")
         .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared"))).config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "6g")
         .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def value(spark):
    """Evaluate one column expression over named values."""
    from pyspark.sql import functions as F

    def get(expression, schema=None, **row):
        df = spark.createDataFrame([tuple(row.values())], schema or ", ".join(f"{k} string" for k in row))
        return df.select(expression.alias("v")).first()["v"]
    return get

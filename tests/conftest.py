import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from loadkit.session import work_root
    s = (SparkSession.builder.master("local[4]").appName("loadkit-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    work_root(s)
    yield s


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)


SMALL = "/root/testdata/sf0.001"

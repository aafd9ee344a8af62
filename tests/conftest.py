import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    scratch = tempfile.mkdtemp(prefix="strata-tests-")
    spark = (
        SparkSession.builder.master("local[*]")
        .appName("strata-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", os.path.join(scratch, "ckpt"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="strata-test-")


def rows(df, order=None):
    """Collected rows as tuples, sorted (None sorts first)."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((x is not None, x) for x in t))

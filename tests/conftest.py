import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from splitlens.session import configure

    warehouse = tempfile.mkdtemp(prefix="splitlens-wh-")
    ckpt = tempfile.mkdtemp(prefix="splitlens-ck-")
    s = (SparkSession.builder.master("local[4]")
         .appName("splitlens-tests")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.warehouse.dir", warehouse)
         .config("spark.checkpoint.dir", ckpt)
         .config("spark.driver.memory", "4g")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    configure(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def fx(spark):
    from splitlens.sources.fixtures import Fixtures
    return Fixtures(spark, SF_SMALL)


def frame(spark, schema, rows):
    """Frame of ``schema`` from dicts (missing keys are NULL)."""
    names = [f.name for f in schema.fields]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)

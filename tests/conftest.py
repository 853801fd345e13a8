import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent
sys.path.insert(0, str(ROOT.parent))
sys.path.insert(0, str(ROOT))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from check import session

    spark = session(cores=4)
    yield spark
    spark.stop()


@pytest.fixture
def values(spark):
    """Evaluate a column expression over one-column rows: ``values(fn, [..])``."""
    from pyspark.sql import functions as F

    def run(expression, inputs, kind="string"):
        rows = spark.createDataFrame([(i, x) for i, x in enumerate(inputs)], f"i int, x {kind}")
        return [r[0] for r in rows.orderBy("i").select(expression(F.col("x"))).collect()]

    return run

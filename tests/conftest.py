import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from quire.session import get_session
    s = get_session("local[4]", shuffle_partitions=4, app_name="quire-tests")
    yield s
    s.stop()


def one(spark, col, value, schema="x string"):
    """Evaluate a column function on one value."""
    df = spark.createDataFrame([(value,)], schema)
    return df.select(col).first()[0]

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from gleanspark.session import get_spark
    s = get_spark("gleanspark-tests", master="local[*]", shuffle_partitions=8,
                  extra={"spark.driver.memory": "8g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def rows(df):
    return [tuple(r) for r in df.collect()]

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from wellspark.session import local_session
    s = local_session("*", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def tables_small(spark):
    from wellspark.sources.tables import Tables
    return Tables(spark, SF_SMALL)


@pytest.fixture(scope="session")
def tables_mid(spark):
    from wellspark.sources.tables import Tables
    return Tables(spark, SF_MID)

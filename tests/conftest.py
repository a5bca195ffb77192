import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from asofstore.session import local_session
    s = local_session("*", shuffle_partitions=8, app_name="asofstore-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def con():
    import oracle
    return oracle.duck(SF_SMALL)


@pytest.fixture(scope="session")
def results(spark):
    from asofstore.sources.tables import session_results
    return session_results(spark, SF_SMALL).cache()


def rows(spark, data, schema=None):
    from asofstore.schema import SESSION_RESULTS
    return spark.createDataFrame(data, schema or SESSION_RESULTS)

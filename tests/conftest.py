import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tessera.session import get_spark

    s = get_spark(master="local[4]", app="tessera-tests", **{"spark.sql.shuffle.partitions": "4"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def pytest_collection_modifyitems(config, items):
    if not os.path.isdir(SF_SMALL):
        skip = pytest.mark.skip(reason="test data not present")
        for it in items:
            it.add_marker(skip)

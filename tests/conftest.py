import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from fleetlake.session import build_session

    s = build_session("local[*]", shuffle_partitions=8, extra={"spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture()
def tmp(tmp_path_factory):
    return tempfile.mkdtemp(prefix="run-", dir=str(tmp_path_factory.getbasetemp()))


SF_SMALL = "/root/testdata/sf0.001"

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from stationlens.session import checkpoint_dir, get_spark

    s = get_spark(app="stationlens-tests", master="local[4]", shuffle_partitions=4)
    checkpoint_dir(s)  # tests only: a scratch folder when none is configured
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="stationlens-test-")


SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"

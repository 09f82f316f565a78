import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from ledgerspark.session import build_session
    s = build_session("local[4]", shuffle_partitions=8, app_name="ledgerspark-tests")
    if not s.sparkContext.getCheckpointDir():   # tests only: no shared folder configured
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerspark-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL

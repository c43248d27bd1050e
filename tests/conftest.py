import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from riskloom.session import build_session, release_scratch
    s = build_session("local[4]", shuffle_partitions=4)
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="riskloom-test-ckpt-"))
    yield s
    release_scratch(s)
    s.stop()

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import build_session, checkpoint_root
    s = build_session(master="local[4]", shuffle_partitions=4)
    checkpoint_root(s)
    yield s
    s.stop()


@pytest.fixture()
def tmp_root(spark):
    """A fresh folder under the session's checkpoint root."""
    from tidemark.session import scratch_dir
    return scratch_dir(spark, "test")

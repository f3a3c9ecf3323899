import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from triad.session import build_session, checkpoint_dir

    s = build_session(master="local[4]", shuffle_partitions=4)
    checkpoint_dir(s)  # tests are local: a private folder is allowed here
    yield s
    s.stop()

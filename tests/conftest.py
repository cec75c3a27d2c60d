import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from editpulse.session import checkpoint_root, local_session

    s = local_session(cores="*", shuffle_partitions=8)
    checkpoint_root(s)  # unset in tests: a fresh local scratch root
    yield s
    s.stop()


@pytest.fixture
def scratch(spark):
    from editpulse.session import scratch_dir

    return scratch_dir(spark, "test")

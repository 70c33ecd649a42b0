import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from vitalis.session import checkpoint_dir, local_session

    s = local_session(cores="4", shuffle_partitions=8, app="vitalis-tests")
    checkpoint_dir(s)  # tests only: nothing configured, so the warehouse is taken
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="vitalis-test-")

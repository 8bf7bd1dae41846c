import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from dimledger.session import build_session, checkpoint_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app="dimledger-tests", shuffle_partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    # Tests have no cluster setting; give them a private shared folder.
    checkpoint_dir(s, fallback=tempfile.mkdtemp(prefix="dimledger-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="dimledger-test-")

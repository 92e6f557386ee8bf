import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tickbar.session import build_session

    s = build_session(master="local[*]", shuffle_partitions=8)  # checkpoint dir created only if unset
    yield s
    from tickbar.session import drop_scratch

    drop_scratch(s)
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="tickbar-test-")

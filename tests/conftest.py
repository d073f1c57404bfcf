import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from shelfcast.session import build_session, ensure_checkpoint_dir

    s = build_session("local[4]", app_name="shelfcast-tests", shuffle_partitions=8, driver_memory="4g")
    ensure_checkpoint_dir(s, tempfile.mkdtemp(prefix="shelfcast-test-ckpt-"))
    yield s
    s.stop()


SF_SMALL = "/root/testdata/sf0.001"

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from modelyard.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=4, app="modelyard-tests")
    if not s.sparkContext._jsc.sc().getCheckpointDir().isDefined():  # noqa: SLF001
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="modelyard-test-ckpt-"))
    yield s
    s.stop()

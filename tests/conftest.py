import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from cartograph.session import local_session
    # local_session sets spark.checkpoint.dir only when the session has none
    s = local_session("*", 8, scratch=tempfile.mkdtemp(prefix="cartograph-test-"))
    yield s


@pytest.fixture()
def tmpdir_spark(tmp_path):
    return str(tmp_path)

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from matchlake.session import build_session
    s = build_session("local[4]", 4, app="matchlake-tests")
    yield s
    s.stop()


@pytest.fixture()
def tmpdir_spark(spark, tmp_path):
    return str(tmp_path)

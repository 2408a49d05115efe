import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    os.environ.setdefault("MASKCORPUS_SCRATCH", tempfile.mkdtemp(prefix="maskcorpus-tests-"))
    from maskcorpus.session import build_session
    s = build_session("local[*]", 8, app_name="maskcorpus-tests")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="maskcorpus-t-", dir=os.environ.get("MASKCORPUS_SCRATCH"))

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from tallyhawk.session import get_session

    s = get_session("local[4]", app="tallyhawk-tests", shuffle_partitions=4)
    # tests only: the checkpoint folder is unset locally, so give it one
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="th-cp-"))
    yield s
    s.stop()


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="th-run-")

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from wirelake.session import get_session

    session = get_session(master="local[8]", app="wirelake-tests",
                          **{"spark.sql.shuffle.partitions": "8"})
    if not session.conf.get("spark.checkpoint.dir", None):
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="wirelake-test-chk-"))
    yield session


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="wirelake-test-")

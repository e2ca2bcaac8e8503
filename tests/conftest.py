import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    # The shared folder comes from the session's spark.checkpoint.dir; only
    # when that is unset does tillmart.session create a private one.
    from tillmart.session import build_session

    session = build_session(master="local[8]", shuffle_partitions=8)
    yield session
    session.stop()


@pytest.fixture()
def tmp_uri(tmp_path):
    return "file://" + str(tmp_path)

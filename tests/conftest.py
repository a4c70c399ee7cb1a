import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from orderlake.session import build_session
    s = build_session("local[4]", shuffle_partitions=4,
                      extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="orderlake-test-wh-")})
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="orderlake-test-ckpt-"))
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="orderlake-test-")

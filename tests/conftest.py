import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from txmart.session import local_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    extra = {"spark.sql.shuffle.partitions": "4"}
    s = local_session(4, app="txmart-tests", extra=extra)
    # tests set their own checkpoint folder only when the session names none
    if s.conf.get("spark.checkpoint.dir", None) is None and s.sparkContext.getCheckpointDir() is None:
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="txmart-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_root(tmp_path):
    return str(tmp_path)

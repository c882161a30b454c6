import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from fundspark.session import build_session, checkpoint_dir

    s = build_session("local[*]", 8, "fundspark-tests")
    # tests only: the cluster names its shared folder in spark.checkpoint.dir
    checkpoint_dir(s, fallback=tempfile.mkdtemp(prefix="fundspark-ckpt-", dir="/tmp"))
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="fundspark-test-", dir="/tmp")

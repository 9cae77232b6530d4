import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from workpulse.session import build_session
    s = build_session("local[4]", app="workpulse-tests", shuffle_partitions=4)
    # Tests set their own checkpoint folder (the cluster names one in spark.checkpoint.dir).
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="wp-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_table(tmp_path):
    return str(tmp_path / "snapshot")

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from quarry.session import get_session

    scratch = tempfile.mkdtemp(prefix="quarry-test-")
    s = get_session("local[4]", shuffle_partitions=4, app_name="quarry-tests",
                    extra={"spark.checkpoint.dir": f"{scratch}/ckpt",
                           "spark.local.dir": f"{scratch}/local"})
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="quarry-case-")


SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"

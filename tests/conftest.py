import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from quarry.session import get_spark

    s = get_spark("local[4]", app="quarry-tests", shuffle_partitions=8,
                  extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="quarry-test-ckpt-")})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def small_dir():
    return SMALL

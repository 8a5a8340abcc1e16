import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from paddock.session import checkpoint_dir, get_spark
    s = get_spark("tests", cpus=4, shuffle_partitions=4)
    checkpoint_dir(s, fallback=tempfile.mkdtemp(prefix="paddock-ckpt-"))
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="paddock-test-")

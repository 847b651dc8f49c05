import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from gapwise.session import checkpoint_root, get_spark
    s = get_spark("local[4]", app="gapwise-tests", shuffle_partitions=4)
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_root(s)  # sets one only when the deployment left it unset
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="gapwise-test-")

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from hublytics import get_session
    from hublytics.session import checkpoint_dir
    s = get_session("local[*]", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(s)  # unset in tests: a fresh local scratch folder
    yield s


@pytest.fixture(scope="session")
def tmp_root(tmp_path_factory):
    return str(tmp_path_factory.mktemp("hublytics"))

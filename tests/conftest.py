import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from eventide import get_session
    s = get_session("local[4]", 4, app_name="eventide-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s


def rows(df, *cols):
    """Sorted tuples of ``cols`` (all columns if none) for order-free asserts."""
    cols = cols or tuple(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


SF_SMALL = "/root/testdata/sf0.001"
requires_testdata = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="driver test data absent")

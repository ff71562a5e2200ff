import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from parcel.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[*]", **{"spark.sql.shuffle.partitions": "8"})
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture()
def tmp_root():
    # a fresh folder per test; never cleaned by rm
    return tempfile.mkdtemp(prefix="parcel-test-")

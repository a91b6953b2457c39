import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("RESALE_DRIVER_MEMORY", "6g")

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from resale.session import get_session

    s = get_session("local[*]", 8, app="resale-tests")
    yield s
    s.stop()

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from catalog.check import session

    s = session()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()

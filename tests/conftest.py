import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from furrow.session import build_session

    s = build_session(app="furrow-tests", cpus=8, shuffle_partitions=8, driver_memory="8g")
    yield s
    s.stop()


SF = "/root/testdata/sf0.001"

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from siftstone.session import local_session

    session = local_session(cpus=4, memory="4g", partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()

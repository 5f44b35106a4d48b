import os
import sys
import tempfile

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]


@pytest.fixture(scope="session")
def spark():
    from tabloom.session import local_session

    session = local_session("tests", 8, 4)
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tabloom-tests-"))
    yield session
    session.stop()

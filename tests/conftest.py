import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from medloom.session import local_session

    session = local_session("tests", cores=4, memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    folder = os.environ.get("MEDLOOM_DATA", "/root/testdata/sf0.001")
    if not os.path.isdir(folder):
        pytest.skip("no test tables here")
    return folder

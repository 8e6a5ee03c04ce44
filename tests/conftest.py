import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from cladeflow.session import build_session

    session = build_session("local[4]", 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    from cladeflow.session import clear

    clear(session)
    session.stop()


@pytest.fixture(scope="session")
def data_dir():
    if not os.path.isdir(DATA):
        pytest.skip("no test tables here")
    return DATA

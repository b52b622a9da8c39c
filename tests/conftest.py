from __future__ import annotations

import pytest

from tests.compare import TESTDATA, database, make_session


@pytest.fixture(scope="session")
def spark():
    session = make_session()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="session")
def duck(small):
    return database(small)

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from check import database, session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return session(cores=4)


@pytest.fixture(scope="session")
def duck():
    return database(SMALL)


@pytest.fixture(scope="session")
def folder():
    return SMALL

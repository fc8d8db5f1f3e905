import os

import pytest

from foliospark.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(memory="8g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

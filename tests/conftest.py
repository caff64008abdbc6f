import pytest

from encore.session import prepare
from tests.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = prepare(local_session())
    yield session
    session.stop()

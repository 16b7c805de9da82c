import pytest

from threadline.session import build_session, prepare


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[8]", 8)
    prepare(session)
    yield session
    session.stop()

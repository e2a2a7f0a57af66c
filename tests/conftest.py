import pytest

from dictspark.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()

import pytest

from cohortry.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session(cpus=4, shuffle_partitions=4)
    yield session
    session.stop()

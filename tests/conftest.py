import pytest

from linkloom.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", "4", spark__sql__shuffle__partitions="4")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()

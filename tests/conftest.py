import pytest

from tests.oracle import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("4")
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture
def shared(spark, tmp_path):
    """A fresh folder for one test."""
    return str(tmp_path)

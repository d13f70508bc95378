import pytest


@pytest.fixture(scope="session")
def spark():
    from lexspark.session import local_session

    s = local_session("tests", "4")
    s.conf.set("spark.sql.shuffle.partitions", "4")
    yield s
    s.stop()

import pytest

from lexloom.runtime import session


@pytest.fixture(scope="session")
def spark():
    s = session("tests", 4, spark__sql__shuffle__partitions="4", spark__driver__memory="4g")
    yield s
    s.stop()

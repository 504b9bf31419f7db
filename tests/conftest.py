import pytest

from tradewind.session import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session("tests", "4", "6g")


@pytest.fixture(scope="session")
def rows(spark):
    """``rows("a int, b string", [...])`` as a frame."""
    return lambda schema, data: spark.createDataFrame(data, schema)

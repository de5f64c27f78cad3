import pytest
from comparing import connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def duck():
    return connect(SF_DIR)


@pytest.fixture(scope="session")
def given(spark):
    """A given table as a list of rows."""
    return lambda name: spark.read.parquet(f"{SF_DIR}/{name}.parquet").collect()

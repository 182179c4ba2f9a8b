import pytest


@pytest.fixture(scope="session")
def spark_session(spark):
    """The session under a name that hypothesis accepts beside generated arguments."""
    return spark

import pytest


@pytest.fixture(scope="session")
def shared(spark):
    """Workers of the tests' session import the package from the source folder."""
    from clickpipe.llm.common import workers_import

    workers_import(spark)
    return spark

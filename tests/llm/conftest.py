import pytest

from kinfold.llm.common import ship_package


@pytest.fixture(scope="session", autouse=True)
def package_on_workers(spark):
    ship_package(spark)

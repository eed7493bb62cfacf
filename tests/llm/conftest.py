import pytest

from millrace.llm.base import ready


@pytest.fixture(scope="session", autouse=True)
def session(spark):
    return ready(spark)

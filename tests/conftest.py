import pytest

from tests.session import get_spark


@pytest.fixture(scope="session")
def spark():
    return get_spark()

import pytest


@pytest.fixture
def sf001():
    return "/root/testdata/sf0.001"


@pytest.fixture
def sf01():
    return "/root/testdata/sf0.01"

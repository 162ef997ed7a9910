import os

import pytest


@pytest.fixture(scope="session")
def small(sf):
    """The smallest tables that have what a query is about."""
    return os.environ.get("TEST_SF_DIR", sf)

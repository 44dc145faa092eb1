import os
import tempfile

import pytest

from covenant.session import local_session, shared_folder


@pytest.fixture(scope="session")
def spark():
    return local_session("tests", 8)


@pytest.fixture
def work(spark):
    """A new folder for one test."""
    root = shared_folder(spark)
    os.makedirs(root, exist_ok=True)
    return tempfile.mkdtemp(prefix="test-", dir=root)

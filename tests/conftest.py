import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfline import configure  # noqa: E402
from tests.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = configure(local_session(8, 4))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture
def frame(spark):
    """DataFrame from rows and a DDL schema."""

    def build(ddl, *rows):
        return spark.createDataFrame(list(rows), ddl)

    return build

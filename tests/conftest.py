import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import pytest

from lacquer.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", os.environ.get("TEST_CPUS", "4"), **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()

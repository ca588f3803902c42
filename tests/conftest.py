import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from riskloom.runtime import build_session

    session = build_session("tests", 8, **{"spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()

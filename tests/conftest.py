import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent.parent / "tools"))

from demesne.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", 4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make(spark):
    return lambda rows, schema: spark.createDataFrame(rows, schema)

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from vacancia.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def as_of():
    from pyspark.sql import functions as F

    return lambda text="2024-06-15 12:00:00": F.lit(text).cast("timestamp")

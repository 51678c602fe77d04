import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from crmflow.session import local_session  # noqa: E402
from tests.compare import connect  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(cores="8", **{"spark.sql.shuffle.partitions": "4"})


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def duck():
    return connect(SMALL)


def values(df):
    """Rows of a frame as a sorted list of tuples, NULL-safe."""
    return sorted((tuple(row) for row in df.collect()), key=repr)

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from worklink.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture()
def value(spark):
    """Evaluates a Column built from literals."""

    def run(column):
        return spark.range(1).select(column.alias("v")).first().v

    return run

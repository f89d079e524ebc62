import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from rollbook.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(scratch=str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture
def value(spark):
    """Evaluate Columns on one row."""

    def run(*columns):
        row = spark.range(1).select(*columns).collect()[0]
        return row[0] if len(columns) == 1 else tuple(row)

    return run

import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from tablework.session import local_session, prepare  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = prepare(local_session(8, app="tablework-tests"))
    yield session
    session.stop()


@pytest.fixture
def many_partitions(spark):
    """Keep small shuffles apart, so that code which must work across partitions meets several."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")

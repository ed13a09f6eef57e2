import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from touchline.session import local_session  # noqa: E402
from touchline.sources.tables import Warehouse  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = {"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))}
    session = local_session(8, shuffle_partitions=4, **shared)
    yield session
    session.stop()


@pytest.fixture
def wh(spark, tmp_path):
    """A warehouse for fixtures that name parents nobody stored."""
    return Warehouse(spark, str(tmp_path / "warehouse"), enforce=["not_null"])


@pytest.fixture
def rows(spark):
    """Collect a frame as sorted tuples."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return collect

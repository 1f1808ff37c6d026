import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rapport.schemas import TABLES, struct  # noqa: E402
from rapport.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("shared"))
    session = local_session(4, "rapport-tests", **{"spark.checkpoint.dir": folder})
    yield session
    session.stop()


@pytest.fixture
def shuffled_joins(spark):
    """Joins as a large cluster plans them: nothing is small enough to broadcast."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


@pytest.fixture
def frame(spark):
    """A small DataFrame with the schema of an input table; columns left out are null."""

    def build(table, rows, **columns):
        schema = struct(**columns) if columns else TABLES[table]
        return spark.createDataFrame([tuple(row.get(c) for c in schema.names) for row in rows], schema)

    return build

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from vigil.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    session = local_session(8, shuffle_partitions=4, **{"spark.checkpoint.dir": shared, "spark.sql.warehouse.dir": f"{shared}/tables"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """DataFrame from rows under a DDL schema; columns may be a subset given as ``a, b``."""

    def make(rows, schema):
        return spark.createDataFrame(rows, schema)

    return make

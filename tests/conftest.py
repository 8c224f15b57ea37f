import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from civicloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = local_session(
        8,
        memory="6g",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(root / "checkpoints"),
            "spark.sql.warehouse.dir": str(root / "warehouse"),
        },
    )
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Collect a DataFrame as a sorted list of tuples."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return collect

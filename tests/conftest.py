import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from curbstar.session import local_session  # noqa: E402
from curbstar.sources.schemas import RAW_TABLES, all_text  # noqa: E402
from curbstar.sources.store import Store  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        4,
        app="curbstar-tests",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch")),
        },
    )
    yield session
    session.stop()


@pytest.fixture
def store(spark):
    return Store.scratch(spark)


@pytest.fixture
def raw(spark):
    """Build a raw extract from partial rows; columns that are not given are NULL."""

    def build(table, rows, **defaults):
        columns = RAW_TABLES[table]
        full = [tuple({**defaults, **row}.get(c) for c in columns) for row in rows]
        return spark.createDataFrame(full, all_text(columns))

    return build


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def set_option(name, value):
        before.setdefault(name, spark.conf.get(name, None))
        spark.conf.set(name, value)

    yield set_option
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)

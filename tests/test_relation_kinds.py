"""In the catalog, a layer's table may become a view of the same name, and a view a table."""

import pytest
from pyspark.errors import AnalysisException

from curbstar.sources.store import Store


def kinds(spark):
    return {t.name: t.tableType for t in spark.catalog.listTables("kinds")}


def test_a_table_gives_way_to_a_view_and_back(spark):
    store = Store(spark, catalog=True)
    store.table("kinds", "made", spark.range(2))
    assert store.persistent_view("kinds", "made", "SELECT 7 AS id").collect() == [(7,)]
    assert kinds(spark) == {"made": "VIEW"}
    assert store.table("kinds", "made", spark.range(3)).count() == 3
    assert kinds(spark) == {"made": "MANAGED"}


def test_a_table_stays_where_its_view_cannot_be_made(spark):
    store = Store(spark, catalog=True)
    store.table("kinds", "made", spark.range(3))
    # a view over the table that it would replace
    with pytest.raises(AnalysisException):
        store.persistent_view("kinds", "made", "SELECT id FROM kinds.made")
    assert store.read("kinds", "made").count() == 3
    assert kinds(spark) == {"made": "MANAGED"}

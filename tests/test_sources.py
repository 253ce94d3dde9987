import pytest
from pyspark.sql import functions as F

from curbstar.session import scratch_root
from curbstar.sources.readers import read_raw, read_raw_table
from curbstar.sources.schemas import RAW_TABLES
from curbstar.sources.store import Store

TABLE = "source_nyc_311_traffic"


@pytest.fixture
def extract(raw):
    return raw(TABLE, [{"unique_key": "1", "borough": "Bronx"}, {"unique_key": "2", "latitude": "40.7"}])


@pytest.mark.parametrize("fmt", ["parquet", "json", "csv", "orc"])
def test_read_raw(spark, extract, tmp_path, fmt):
    path = str(tmp_path / fmt)
    shuffled = extract.select(*reversed(extract.columns)).withColumn("unique_key", F.col("unique_key").cast("int"))
    writer = shuffled.write.option("header", True) if fmt == "csv" else shuffled.write
    writer.format(fmt).save(path)
    found = read_raw(spark, TABLE, path, fmt)
    assert found.columns == RAW_TABLES[TABLE]
    assert {t for _, t in found.dtypes} == {"string"}
    assert sorted(found.collect(), key=str) == sorted(extract.collect(), key=str)


def test_store_replaces_tables_in_folders(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.table("layer", "t", spark.range(5))
    again = store.table("layer", "t", spark.range(3).withColumn("even", F.col("id") % 2 == 0), ["even"])
    assert again.columns == ["id", "even"] and again.count() == 3
    assert (tmp_path / "layer" / "t" / "even=true").exists()


def test_store_in_the_catalog(spark):
    store = Store(spark, catalog=True)
    store.table("layer_db", "t", spark.range(3))
    store.table("layer_db", "t", spark.range(4))
    assert spark.table("layer_db.t").count() == 4
    store.view("some_view", spark.range(2))
    assert spark.table("some_view").count() == 2


def test_read_raw_table(spark, extract):
    Store(spark, catalog=True).table("raw_db", TABLE, extract.withColumn("extra", F.lit(1)))
    found = read_raw_table(spark, TABLE, "raw_db")
    assert found.columns == [*RAW_TABLES[TABLE], "extra"]
    assert dict(found.dtypes)["extra"] == "string"


@pytest.mark.parametrize("fmt", ["parquet", "json", "csv", "orc"])
def test_undeclared_columns_come_along(spark, extract, tmp_path, fmt):
    path = str(tmp_path / fmt)
    writer = extract.withColumn("more", F.lit(7)).write
    (writer.option("header", True) if fmt == "csv" else writer).format(fmt).save(path)
    found = read_raw(spark, TABLE, path, fmt, extra=["more"])
    assert found.columns == [*RAW_TABLES[TABLE], "more"]
    assert {r.more for r in found.collect()} == {"7"}


def test_scratch_comes_from_the_session(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert Store.scratch(spark).root != Store.scratch(spark).root

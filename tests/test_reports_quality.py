from pyspark.sql import functions as F

from curbstar.operators.quality import Accepted, NotNull, Related, Unique, run_checks
from curbstar.operators.reports import Series, scorecards, series_counts, share_within, total


def test_series_counts(spark):
    dim = spark.createDataFrame([(1, "N", "a"), (2, "N", "b"), (3, None, "c")], "k int, area string, sub string")
    one = spark.createDataFrame([(1,), (1,), (2,), (3,), (9,), (None,)], "k int")
    two = spark.createDataFrame([(2, "x"), (2, "y")], "k int, label string")
    both = [Series("one", one, dim, "k"), Series("two", two, dim, "k")]
    found = [tuple(r) for r in series_counts(both, {"area": "area"}).collect()]
    assert found == [(None, "one", 1), ("N", "one", 3), ("N", "two", 2)]
    split = series_counts([Series(F.col("label"), two, dim, "k")], {"area": "area", "sub": F.upper("sub")})
    assert [tuple(r) for r in split.collect()] == [("N", "B", "x", 1), ("N", "B", "y", 1)]


def test_share_within(spark):
    places = spark.createDataFrame([(1, "N"), (2, "N"), (3, "S")], "p int, area string")
    kinds = spark.createDataFrame([(1, "x"), (2, "y")], "t int, kind string")
    fact = spark.createDataFrame([(1, 1), (2, 1), (2, 2), (3, 2), (None, 1)], "p int, t int")
    shares = share_within(fact, (places, "p", "area"), (kinds, "t", "kind"), "n", "share")
    assert [tuple(r) for r in shares.collect()] == [("N", "x", 2, 66.67), ("N", "y", 1, 33.33), ("S", "y", 1, 100.0)]


def test_totals(spark):
    assert total(spark.range(5), "n").first().n == 5
    assert [tuple(r) for r in scorecards({"a": spark.range(2), "b": spark.range(0)}).collect()] == [("a", 2), ("b", 0)]


def test_checks(spark):
    child = spark.createDataFrame(
        [(1, "x"), (1, "y"), (1, None), (2, "z"), (None, "x"), (7, "x"), (7, "x"), (None, "q")], "id int, v string"
    )
    parent = spark.createDataFrame([(1,), (2,), (None,)], "id int")
    checks = [
        NotNull("child", "id"),
        Unique("child", "id"),
        Accepted("child", "v", ("x", "y", "z")),
        Related("child", "id", "parent", "id"),
        Unique("parent", "id"),
    ]
    report = run_checks({"child": child, "parent": parent}, checks)
    assert report.columns == ["table_name", "column_name", "check_name", "failures"]
    assert {tuple(r) for r in report.collect()} == {
        ("child", "id", "not_null", 2),
        ("child", "id", "unique", 2),
        ("child", "v", "accepted_values", 1),
        ("child", "id", "relationships", 2),
        ("parent", "id", "unique", 0),
    }

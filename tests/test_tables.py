"""Deduplication, dimensions, sequential keys and lookups."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from curbstar.operators.dedup import dedup_latest
from curbstar.operators.dims import (
    conformed_dim,
    distinct_dim,
    grouped_dim,
    representative,
    sequence_key,
)
from curbstar.operators.lookup import (
    Lookup,
    build_fact,
    lookup_columns,
    lookup_fk,
    lookup_role,
    measured_bytes,
    natural,
)
from curbstar.operators.project import require, safe_project, strict_project


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_projections_and_filter(spark):
    df = spark.createDataFrame([("1", "x", "keep"), ("a", "y", "keep"), (None, "x", "keep")], "id string, kind string, extra string")
    typed = safe_project(df, {"n": ("id", "int"), "kind": "kind", "shout": F.upper("kind")})
    assert [tuple(r) for r in typed.collect()] == [(1, "x", "X"), (None, "y", "Y"), (None, "x", "X")]
    strict = strict_project(df, ["id"], {"key": F.col("id")})
    assert strict.columns == ["kind", "extra", "key"]
    assert require(df, ["id"], {"kind": ["x"]}).count() == 1


def test_dedup_keeps_latest_and_breaks_ties(spark):
    rows = [(1, 10, "b"), (1, 20, "c"), (1, 20, "a"), (2, None, "z"), (2, 5, "y"), (None, 1, "n"), (None, 2, "m")]
    df = spark.createDataFrame(rows, "k int, t int, v string")
    latest = dedup_latest(df, ["k"], F.col("t"), ["v"])
    # One row per key and map task before the shuffle, so a hot key stays cheap.
    above, below = plan_text(latest).split("Exchange hashpartitioning")
    assert "WindowGroupLimit" in above and "WindowGroupLimit" in below
    assert sorted((tuple(r) for r in latest.collect()), key=str) == [(1, 20, "a"), (2, 5, "y"), (None, 2, "m")]


def test_dimensions(spark):
    a = spark.createDataFrame([("x", None), ("x", None), ("y", 1)], "b string, d int")
    b = spark.createDataFrame([("x", None), (None, 2)], "b string, d int")
    assert conformed_dim([a, b]).count() == 3
    assert conformed_dim([a, b], not_null=["b"]).count() == 2
    assert distinct_dim(a, ["b", (F.col("d") == 1).alias("one")]).count() == 2
    grouped = grouped_dim(a, ["b"], {"d": F.max("d"), "any": representative("d", deterministic=False)})
    assert {r.b: (r.d, r["any"]) for r in grouped.collect()} == {"x": (None, None), "y": (1, 1)}


@pytest.mark.parametrize("ranges", [1, 7])
def test_sequence_key_equals_row_number(spark, store, conf, ranges):
    conf("spark.sql.shuffle.partitions", str(ranges))
    conf("spark.sql.adaptive.coalescePartitions.enabled", str(ranges == 1).lower())
    rng = random.Random(3)
    pairs = {(rng.choice([None, "a", "b", "Z", "é"]), rng.choice([None, *range(300)])) for _ in range(2000)}
    df = spark.createDataFrame(list(pairs), "s string, n int")
    keyed = sequence_key(df, ["s", "n"], "k", store)
    expected = df.withColumn("k", F.row_number().over(Window.orderBy("s", "n")).cast("bigint"))
    assert keyed.columns == ["k", "s", "n"]
    assert sorted(keyed.collect(), key=str) == sorted(expected.select("k", "s", "n").collect(), key=str)
    assert (len(keyed.inputFiles()) == 1) == (ranges == 1)


def test_sequence_key_of_nothing(spark, store):
    df = spark.createDataFrame([], "s string")
    assert sequence_key(df, ["s"], "k", store).count() == 0


@pytest.fixture
def star(spark):
    fact = spark.createDataFrame(
        [(1, "x", None), (2, "x", "1"), (3, None, "1"), (4, "q", "1"), (5, "x", "")], "id int, a string, b string"
    )
    dim = spark.createDataFrame(
        [(10, "x", None), (20, "x", "1"), (30, None, "1"), (40, "x", "")], "key int, a string, b string"
    )
    return fact, dim


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("hot_rows", [1, 1_000_000])
@pytest.mark.parametrize(
    "options, expected",
    [
        ({"null_safe": True}, {1: {10}, 2: {20}, 3: {30}, 4: {None}, 5: {40}}),
        ({}, {1: {None}, 2: {20}, 3: {None}, 4: {None}, 5: {40}}),
        ({"null_safe": {"b"}}, {1: {10}, 2: {20}, 3: {None}, 4: {None}, 5: {40}}),
        # NULL and blank stand for the same text: two dimension rows match, as in the plain join.
        ({"null_as": {"b": ""}}, {1: {10, 40}, 2: {20}, 3: {None}, 4: {None}, 5: {10, 40}}),
    ],
)
def test_lookup_null_rules(star, small, hot_rows, options, expected):
    fact, dim = star
    found = lookup_fk(fact, Lookup(dim, "key", natural("a", "b"), "fk", **options), small, hot_rows=hot_rows)
    assert found.columns == ["id", "a", "b", "fk"]
    result = {}
    for r in found.collect():
        result.setdefault(r.id, set()).add(r.fk)
    assert result == expected


def test_lookup_on_expressions(spark, star):
    fact, _ = star
    dim = spark.createDataFrame([(1, True, "x"), (2, False, "x")], "key int, flag boolean, a string")
    on = {"a": "a", "flag": F.coalesce(F.col("b") == "1", F.lit(False))}
    found = lookup_fk(fact, Lookup(dim, "key", on))
    assert {r.id: r.key for r in found.collect()} == {1: 2, 2: 1, 3: None, 4: None, 5: 2}


def test_large_lookup_spreads_hot_and_null_keys(spark, conf):
    """A third of the rows share one key and a third have none; no shuffle piece gets them all."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    conf("spark.sql.shuffle.partitions", "16")
    n = 30_000
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.col("id"))
    fact = spark.range(n).withColumn("natural", key)
    dim = spark.range(n).select(F.col("id").alias("natural"), (F.col("id") * 10).alias("key"))
    lookup = Lookup(dim, "key", natural("natural"))
    found = lookup_fk(fact, lookup, small=False, spread_by=["id"], hot_rows=1000)
    text = plan_text(found)
    assert "SortMergeJoin" in text and "_piece" in text.split("SortMergeJoin")[1].split("\n")[0]
    wrong = found.filter(~F.col("key").eqNullSafe(F.col("natural") * 10))
    assert found.count() == n and wrong.count() == 0
    per_task = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert max(per_task) < n / 16 * 2


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("hot_rows", [1, 2, 1_000_000])
def test_lookup_columns_is_an_inner_join(spark, small, hot_rows):
    fact = spark.createDataFrame([(1, 5), (2, 5), (3, 6), (4, None), (5, 9)], "id int, k int")
    dim = spark.createDataFrame([(5, None, "five"), (6, 60, "six"), (7, 70, "seven")], "k int, n int, name string")
    found = lookup_columns(fact, dim, natural("k"), ["n", "name"], small, hot_rows=hot_rows)
    assert found.columns == ["id", "k", "n", "name"]
    assert sorted(map(tuple, found.collect())) == [(1, 5, None, "five"), (2, 5, None, "five"), (3, 6, 60, "six")]


def test_measured_bytes_decides(spark, star):
    fact, dim = star
    assert measured_bytes([dim, dim.select("key"), dim.limit(0)]) == [4 * 48 + 5, 4 * 16, 0]
    assert "BroadcastHashJoin" in plan_text(lookup_fk(fact, Lookup(dim, "key", natural("a"))))


def test_build_fact(star):
    fact, dim = star
    lookups = [
        Lookup(dim, "key", natural("a", "b"), "tolerant", null_safe=True),
        Lookup(dim, "key", natural("a", "b"), "strict"),
    ]
    built = build_fact(fact, lookups, ["id", "tolerant", "strict"])
    assert sorted(tuple(r) for r in built.collect())[0] == (1, 10, None)
    assert build_fact(fact, [], ["id"]).count() == 5


def test_roles_share_one_broadcast(spark, store):
    days = spark.sql(
        "SELECT d AS full_date, int(date_format(d, 'yyyyMMdd')) AS date_key "
        "FROM (SELECT explode(sequence(date'2024-01-01', date'2024-01-31')) AS d)"
    )
    dim = store.table("marts", "days", days)
    fact = spark.sql(
        "SELECT * FROM VALUES (1, timestamp_ntz'2024-01-02 10:00:00', timestamp_ntz'2024-01-05 00:00:00', null), "
        "(2, timestamp_ntz'2023-12-31 23:59:59', null, timestamp_ntz'2024-01-31 23:00:00') AS t(id, a, b, c)"
    )
    found = lookup_role(store.table("marts", "fact", fact), dim, {"a": "a_key", "b": "b_key", "c": "c_key"})
    rows = {r.id: (r.a_key, r.b_key, r.c_key) for r in found.collect()}
    assert rows == {1: (20240102, 20240105, None), 2: (None, None, 20240131)}
    final = plan_text(found).split("== Initial Plan ==")[0]
    assert final.count("ReusedExchange") == 2 and final.count("BroadcastQueryStage") == 3
    assert final.count("+- BroadcastExchange") == 1

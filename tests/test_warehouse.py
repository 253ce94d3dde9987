"""Published builds, partitioned facts, and checks counted while tables are written."""

import os

import pytest
from pyspark.sql import functions as F

from curbstar.operators import lookup
from curbstar.operators.dedup import dedup_latest
from curbstar.operators.project import BadValues, CheckedCasts
from curbstar.operators.quality import Accepted, NotNull, Observed, Unique, run_checks
from curbstar.operators.reports import drill_down
from curbstar.plans import catalog, enforcement
from curbstar.sources.store import Store, Warehouse

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no trade tables")


def final_plan(df):
    """The plan that ran, as its nodes."""
    found, left = [], [df._jdf.queryExecution().executedPlan()]
    while left:
        node = left.pop()
        kind = node.getClass().getSimpleName()
        found.append(node)
        if kind == "AdaptiveSparkPlanExec":
            left.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            left.append(node.plan())
        children = node.children()
        left += [children.apply(i) for i in range(children.size())]
    return found


def kinds(df):
    return [n.getClass().getSimpleName() for n in final_plan(df)]


def metric(df, name):
    values = [n.metrics().get(name) for n in final_plan(df)]
    return [v.get().value() for v in values if v.isDefined()]


# --- hot keys by a sketch -----------------------------------------------------------------------


@pytest.fixture
def keyed(spark):
    """20,000 rows in 4 tasks: a third share a key, a third have none, the others one each."""
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, F.col("id") + 100)
    return spark.range(0, 20_000, 1, 4).select(key.cast("string").alias("k"), "id")


@pytest.mark.parametrize("buckets", [16, 1024])
def test_the_sketch_shuffles_a_row_per_bucket_and_task(monkeypatch, keyed, buckets):
    monkeypatch.setattr(lookup, "SKETCH_BUCKETS", buckets)
    sketch = lookup.key_sketch(keyed, [F.col("k")])
    rows = sketch.collect()
    assert sum(r.rows for r in rows) == 20_000 and len(rows) <= buckets
    assert metric(sketch, "shuffleRecordsWritten") == [sum(metric(sketch, "shuffleRecordsWritten"))]
    assert metric(sketch, "shuffleRecordsWritten")[0] <= buckets * 4


@pytest.mark.parametrize("buckets", [1, 16, 1 << 18])
def test_hot_keys_are_exact_whatever_the_sketch(monkeypatch, keyed, buckets):
    monkeypatch.setattr(lookup, "SKETCH_BUCKETS", buckets)

    def found(rows, least):
        hot = lookup.Hot(rows, least, ("id",))
        return {r[0] for r in lookup._hot_keys(hot, {"_f0": F.col("k")}).collect()}

    assert found(keyed, 1000) == {"7", None}
    assert found(keyed, 7000) == set()
    assert found(keyed.limit(0), 1) == set()


def test_hot_keys_are_few_and_narrow(monkeypatch, keyed):
    monkeypatch.setattr(lookup, "HOT_SHARE", 2)
    hot = lookup.Hot(keyed.filter("id % 3 < 1 or id < 9000"), 1, ("id",))
    # of 12,000 rows only a key with half of them can be hot
    assert [r[0] for r in lookup._hot_keys(hot, {"_f0": F.col("k")}).collect()] == ["7"]
    monkeypatch.undo()
    wide = keyed.withColumn("k", F.concat("k", F.lit("x" * 2000)))
    assert [r[0] for r in lookup._hot_keys(lookup.Hot(wide, 1000, ("id",)), {"_f0": F.col("k")}).collect()] == [None]


# --- builds and manifests -----------------------------------------------------------------------


def test_tables_are_live_once_published(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path))
    written = store.table("layer", "t", spark.range(3).withColumn("even", F.col("id") % 2 == 0), ["even"])
    assert written.count() == 3
    with pytest.raises(LookupError):
        Warehouse(spark, str(tmp_path)).read("layer", "t")
    store.publish()
    reader = Warehouse(spark, str(tmp_path))
    assert reader.read("layer", "t").dtypes == [("id", "bigint"), ("even", "boolean")]
    again = Warehouse(spark, str(tmp_path))
    again.table("layer", "t", spark.range(9))
    again.table("layer", "other", spark.range(2))
    assert reader.read("layer", "t").count() == Warehouse(spark, str(tmp_path)).read("layer", "t").count() == 3
    again.publish()
    assert reader.read("layer", "t").count() == 3, "a reader keeps to the manifest that it began with"
    reader.refresh()
    assert reader.read("layer", "t").count() == 9 and reader.read("layer", "other").count() == 2
    assert reader.versions() == [1, 2]
    assert Warehouse(spark, str(tmp_path), version=1).read("layer", "t").count() == 3


def test_builds_that_publish_at_once_keep_each_others_tables(spark, tmp_path):
    one, two = Warehouse(spark, str(tmp_path)), Warehouse(spark, str(tmp_path))
    one.table("layer", "a", spark.range(1))
    two.table("layer", "b", spark.range(2))
    assert two._add_manifest(1, two._made)
    assert not one._add_manifest(1, one._made), "the number is taken"
    one.publish()
    reader = Warehouse(spark, str(tmp_path))
    assert reader.read("layer", "a").count() == 1 and reader.read("layer", "b").count() == 2
    assert sorted(os.listdir(tmp_path / "manifests"))[-2:] == ["000000000001.json", "000000000002.json"]
    assert not [n for n in os.listdir(tmp_path / "manifests") if n.startswith("_")]


def test_retired_builds_go(spark, tmp_path):
    for n in (1, 2, 3):
        store = Warehouse(spark, str(tmp_path))
        store.table("layer", "t", spark.range(n))
        store.publish()
    running = Warehouse(spark, str(tmp_path))
    running.table("layer", "t", spark.range(4))
    assert running.retire(keep=2) == []
    running.build = "9" * 12
    running.table("layer", "u", spark.range(4))
    assert len(running.retire(keep=2, older_than=0)) == 2
    assert Warehouse(spark, str(tmp_path), version=2).read("layer", "t").count() == 2
    assert len(os.listdir(tmp_path / "builds")) == 3


@needs_tables
def test_a_build_that_dies_leaves_the_old_marts(spark, monkeypatch):
    plan = catalog.published(spark, SF_DIR)
    before = catalog.opened(spark, plan).by_year().collect()
    sources = {name: feed.limit(50) for name, feed in plan.sources.items()}
    later = enforcement.Enforcement(Warehouse(spark, plan.store.root), sources)
    killed = RuntimeError("killed")

    def dies(*_):
        raise killed

    monkeypatch.setattr(enforcement, "dim_bus_stop", dies)
    with pytest.raises(RuntimeError):
        later.build()
    assert before and catalog.opened(spark, plan).by_year().collect() == before
    monkeypatch.undo()
    later.build()
    assert catalog.opened(spark, plan).by_year().collect() != before


# --- partitioned facts --------------------------------------------------------------------------


@needs_tables
def test_a_report_of_one_year_prunes_the_others(spark):
    plan = catalog.published(spark, SF_DIR)
    folder = plan.store.path("marts_core", "fact_ace_violations")
    years = {n for n in os.listdir(folder.removeprefix("file:")) if n.startswith("date_year=")}
    assert len(years) > 3
    found = catalog.opened(spark, plan).by_date("month", where=F.col("year") == 2023)
    rows = found.collect()
    text = found._jdf.queryExecution().executedPlan().toString()
    assert text.count("dynamicpruning") >= 2
    every = catalog.opened(spark, plan).by_date("year", "month").where("year = 2023").drop("year").collect()
    assert rows == every
    scans = [n for n in final_plan(found) if "dynamicpruning" in n.simpleString(10_000)]
    read = [n.metrics().get("numPartitions").get().value() for n in scans
            if n.getClass().getSimpleName() == "FileSourceScanExec"]
    assert read == [1, 1], "one year of each fact is read"


@needs_tables
def test_the_partition_is_no_column_of_the_fact(spark):
    plan = catalog.published(spark, SF_DIR)
    for made in (plan, catalog.opened(spark, plan)):
        fact = made.table("fact_311_complaints")
        assert fact.columns == plan.plan("fact_311_complaints").columns


# --- checks -------------------------------------------------------------------------------------


def test_observed_checks(spark, store):
    df = spark.createDataFrame([(1, "x"), (1, None), (None, "y"), (3, "z")], "id int, v string")
    checks = [NotNull("t", "id"), Accepted("t", "v", ("x", "y")), Unique("t", "id")]
    watched = Observed(checks)
    written = store.table("layer", "t", watched.watch(df))
    assert watched.counts() == {checks[0]: 1, checks[1]: 1}
    report = run_checks({"t": written}, checks, watched.counts())
    assert sorted(r.failures for r in report.collect()) == [1, 1, 1]
    assert sum("Scan" in k for k in kinds(report)) <= 2  # the table for unique, the counts as rows
    nothing = Observed(checks)
    store.table("layer", "none", nothing.watch(df.limit(0)))
    assert nothing.counts() == {checks[0]: 0, checks[1]: 0}
    assert Observed([]).counts() == {}


@needs_tables
def test_a_checked_build_reads_no_table_for_checks_on_rows(spark):
    plan = catalog.enforcement_plan(spark, SF_DIR)
    report = plan.build_checked(enforcement.CHECKS)
    again = run_checks(plan.build(), enforcement.CHECKS)
    assert sorted(report.collect()) == sorted(again.collect())
    scans = kinds(report).count("FileSourceScanExec")
    unique = {c.table for c in enforcement.CHECKS if isinstance(c, Unique)}
    related = [c for c in enforcement.CHECKS if not isinstance(c, (Unique, NotNull, Accepted))]
    assert scans <= len(unique) + 2 * len(related)
    assert kinds(again).count("FileSourceScanExec") > scans


def test_unique_checks_of_a_table_share_an_exchange(spark):
    rows = [(1, "a", 0.0), (1, "b", -0.0), (2, None, None), (None, None, 1.5), (3, "b", 2.5), (4, "", None)]
    df = spark.createDataFrame(rows, "id int, name string, others double")
    checks = [Unique("t", c) for c in ("name", "id", "others", "id")]
    report = run_checks({"t": df}, checks)
    assert [(r.column_name, r.failures) for r in report.collect()] == [("name", 1), ("id", 1), ("others", 1)]
    # one by value, one that adds up the counts
    assert kinds(report).count("ShuffleExchangeExec") == 2
    assert [r.failures for r in run_checks({"t": df.limit(0)}, [checks[0]]).collect()] == [0]


# --- the summary --------------------------------------------------------------------------------


@needs_tables
def test_the_summary_answers_every_report(spark):
    with_summary = catalog.opened(spark, catalog.published(spark, SF_DIR, summarize=True))
    facts_only = catalog.opened(spark, catalog.published(spark, SF_DIR))
    assert with_summary.summarized and not facts_only.summarized
    for name in ("by_borough", "by_year", "by_month", "by_weekday", "type_share_by_borough",
                 "total_violations", "total_complaints"):
        found = getattr(with_summary, name)()
        assert found.collect() == getattr(facts_only, name)().collect()
        scans = [n.simpleString(10_000) for n in final_plan(found) if "FileScan" in n.simpleString(100)]
        assert scans and not any("fact_" in s for s in scans)
    for attributes in (("borough", "neighborhood"), ("peak_period",)):
        through = "by_date" if attributes[0] == "peak_period" else "by_location"
        assert with_summary.drill_down(*attributes).collect() == getattr(facts_only, through)(*attributes).collect()
    year = F.col("year") == 2023
    found = with_summary.by_date("month", where=year)
    assert found.collect() == facts_only.by_date("month", where=year).collect()
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()


def test_drill_down_through_several_dimensions(spark):
    days = spark.createDataFrame([(1, 20, "mon"), (2, 20, "tue"), (3, 21, "tue")], "d int, y int, day string")
    places = spark.createDataFrame([(1, "N"), (2, None)], "p int, area string")
    summary = spark.createDataFrame(
        [("a", 1, 20, 1, 5), ("a", 2, 20, 1, 7), ("b", 2, 20, 2, 1), ("b", 3, 21, None, 2), ("b", 9, 9, 1, 4)],
        "series string, d int, y int, p int, event_count long")
    dims = [(days, ("d", "y")), (places, ("p",))]
    found = [tuple(r) for r in drill_down(summary, dims, ["area", "day"]).collect()]
    assert found == [(None, "tue", "b", 1), ("N", "mon", "a", 5), ("N", "tue", "a", 7)]
    assert [tuple(r) for r in drill_down(summary, dims, ["day"]).collect()] == [
        ("mon", "a", 5), ("tue", "a", 7), ("tue", "b", 3)]
    assert [tuple(r) for r in drill_down(summary, dims, []).collect()] == [("a", 12), ("b", 7)]


# --- strict casts and landings ------------------------------------------------------------------


def test_checked_casts_report_every_column(spark, store):
    df = spark.createDataFrame(
        [("1", "x", "2024-01-01"), ("b", "2.5", None), ("a", None, "soon"), (None, "y", "never")],
        "n string, v string, ts string")
    casts = CheckedCasts({"n": ("n", "bigint"), "value": ("v", "double"), "at": ("ts", "timestamp")})
    written = store.table("layer", "t", casts.project(df, ["v", "ts"]))
    assert written.columns == ["n", "value", "at"] and written.count() == 4
    assert casts.report() == {
        "n": BadValues(2, "a", "b"), "value": BadValues(2, "x", "y"), "at": BadValues(2, "never", "soon")}
    with pytest.raises(ValueError, match="n: 2 rows are no bigint, such as 'a' and 'b'; value: 2 rows"):
        casts.verify()
    good = CheckedCasts({"n": ("n", "bigint")})
    store.table("layer", "good", good.project(df.limit(1)))
    good.verify()
    none = CheckedCasts({"n": ("n", "bigint")})
    store.table("layer", "none", none.project(df.limit(0)))
    none.verify()


@pytest.mark.parametrize("in_catalog", [False, True])
def test_a_landed_table_is_read_without_a_shuffle(spark, store, in_catalog):
    rows = spark.range(2000).select((F.col("id") % 300).alias("a"), (F.col("id") % 2).alias("b"), "id")
    store = Store(spark, catalog=True) if in_catalog else store
    landed = store.land("raw_db", "t", rows, ["a", "b"], 5)
    latest = dedup_latest(landed, ["a", "b"], F.col("id"), ["id"])
    other = store.land("raw_db", "other", rows.select("a", "b").distinct(), ["a", "b"], 5)
    joined = landed.hint("merge").join(other, ["a", "b"])
    assert latest.count() == 300 and joined.count() == 2000
    for df in (latest, joined):
        df.collect()
        assert "ShuffleExchangeExec" not in kinds(df)
    assert sorted(r.id for r in latest.collect()) == list(range(1700, 2000))

"""Staging as catalog views: the same rows as the plans, in any session, whatever is in the extract."""

import pytest

from curbstar.functions.clean import safe_cast, safe_cast_sql
from curbstar.operators.views import classify_prefix_sql, literal
from curbstar.plans.enforcement import STAGING, publish_staging
from curbstar.sources.store import Store

TABLES = [source for source, _ in STAGING.values()]
TIMES = ["2024-03-01T10:00:00.000", "2024-03-01 10:00:00", "2024-03-01T10:00:00+02:00", "2024-02-30", "x", "10:00", None]


def extracts(raw):
    complaints = [
        {"unique_key": str(k % 5), "created_date": t, "closed_date": TIMES[(k + 2) % 7], "borough": "queens",
         "complaint_type": kind, "latitude": n, "longitude": n, "council_district": n, "descriptor": "it's"}
        for k, (t, kind, n) in enumerate(
            (t, kind, n) for t in TIMES for kind in ("Illegal Parking", "Noise", None) for n in ("1.5", "2f", "7", None)
        )
    ]
    violations = [
        {"violation_id": f"v{k % 6}", "first_occurrence": t, "last_occurrence": TIMES[(k + 3) % 7], "bus_route_id": r,
         "violation_type": "A", "violation_latitude": "40.5d", "bus_stop_longitude": "-73.25"}
        for k, (t, r) in enumerate((t, r) for t in TIMES for r in ("BX12", "bm1", "M60+", "Q44", "zz", None))
    ]
    return dict(zip(TABLES, (raw(TABLES[0], complaints), raw(TABLES[1], violations))))


def ordered(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_views_equal_the_plans_in_another_session(spark, raw, conf, ansi):
    conf("spark.sql.ansi.enabled", ansi)
    store = Store(spark, catalog=True)
    made = extracts(raw)
    for name, df in made.items():
        store.table("views_raw", name, df)
    publish_staging(store, {name: f"views_raw.{name}" for name in made})
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "Pacific/Kiritimati")
    for name, (source, staging) in STAGING.items():
        view, plan = other.table(f"staging.{name}"), staging().plan(spark.table(f"views_raw.{source}"))
        assert view.schema == plan.schema
        assert ordered(view) == ordered(plan) and view.count() > 0
        assert spark.catalog.getTable(f"staging.{name}").tableType == "VIEW"


def test_a_view_reads_what_its_source_holds_now(spark, raw):
    store = Store(spark, catalog=True)
    name = TABLES[1]
    df = extracts(raw)[name]
    store.table("views_now", name, df.limit(0))
    view = publish_staging(store, {name: f"views_now.{name}"})["stg_ace"]
    assert view.count() == 0
    store.table("views_now", name, df)
    assert spark.table("staging.stg_ace").count() == STAGING["stg_ace"][1]().plan(df).count() > 0


@pytest.mark.parametrize("to", ["timestamp", "double", "bigint"])
def test_casts_as_sql(spark, to):
    texts = [*TIMES, "1", " 2 ", "1e3", "1.5f", "1.5D", "", "0x1F", "2024-1-2"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select(safe_cast("t", to).alias("a")).collect()
    assert rows == df.selectExpr(safe_cast_sql("t", to) + " AS a").collect()


def test_quotes_in_values(spark):
    odd = "it's a \\ and \\' too"
    assert spark.range(1).selectExpr(literal(odd) + " AS t").first().t == odd
    rule = classify_prefix_sql("'o''Neil'", [(["O'"], "irish's")], "none")
    df = spark.createDataFrame([("o'neil",), ("x",), (None,)], "t string")
    assert [r[0] for r in df.selectExpr(classify_prefix_sql("t", [(["O'"], "irish's")], "none")).collect()] == [
        "irish's", "none", "none"
    ] and rule.startswith("CASE")

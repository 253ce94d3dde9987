"""The request window ends on the UTC day, whatever the session's zone."""

import pytest
from pyspark.sql import functions as F

from curbstar.plans.applications import stg_nyc_311_dot
from curbstar.sources.schemas import RAW_TABLES


@pytest.mark.parametrize("zone", ["Pacific/Kiritimati", "Pacific/Pago_Pago", "UTC"])
def test_today_does_not_depend_on_the_zone(spark, conf, zone):
    conf("spark.sql.session.timeZone", zone)
    now = F.convert_timezone(None, F.lit("UTC"), F.current_timestamp().cast("timestamp_ntz"))
    seconds = F.unix_timestamp(F.current_timestamp())
    days = F.datediff(F.to_date(now), F.lit("1970-01-01").cast("date"))
    assert spark.range(1).select(days == F.floor(seconds / 86400)).first()[0]
    table = next(t for t in RAW_TABLES if "agency_name" in RAW_TABLES[t])
    raw = spark.createDataFrame([], ", ".join(f"{c} string" for c in RAW_TABLES[table]))
    assert stg_nyc_311_dot(raw).count() == 0

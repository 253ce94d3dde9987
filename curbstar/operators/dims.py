"""Dimension tables: calendars, conformed and mart dimensions, sequential keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curbstar import fixed_values as fv
from curbstar.functions import calendar as cal
from curbstar.functions.keys import hash_key
from curbstar.sources.store import Store


def hour_attributes(hours: DataFrame) -> DataFrame:
    """Calendar attributes of one ``full_datetime`` per hour."""
    ts = F.col("full_datetime")
    return hours.select(
        cal.hour_key(ts).alias("date_key"),
        ts,
        F.year(ts).cast("bigint").alias("year"),
        F.month(ts).cast("bigint").alias("month"),
        F.dayofmonth(ts).cast("bigint").alias("day"),
        F.hour(ts).cast("bigint").alias("hour"),
        cal.day_name(ts).alias("day_of_week"),
        cal.weekday_or_weekend(ts).alias("weekday_or_weekend"),
        cal.peak_period(ts).alias("peak_period"),
    )


def hour_dim(
    spark: SparkSession, start: str = fv.CALENDAR_START, n_hours: int = fv.CALENDAR_HOURS
) -> DataFrame:
    """Hour-grain calendar of ``n_hours`` after ``start``, both ends included."""
    first = F.lit(start).cast("timestamp_ntz")
    hours = spark.range(n_hours + 1).select(
        F.timestamp_add("HOUR", F.col("id"), first).alias("full_datetime")
    )
    return hour_attributes(hours)


def hour_dim_spanning(df: DataFrame, ts: str) -> DataFrame:
    """Hour-grain calendar from the first to the last observed hour."""
    first, last = df.agg(cal.hour_start(F.min(ts)), F.max(ts)).first()
    if first is None:
        return hour_dim(df.sparkSession, n_hours=-1)
    return hour_dim(df.sparkSession, str(first), (last - first) // timedelta(hours=1))


def date_dim_from(
    sources: Sequence[tuple[DataFrame, str]], fiscal_start: int = fv.FISCAL_START_MONTH
) -> DataFrame:
    """Day-grain calendar of the days observed in any ``(table, timestamp column)``."""
    days = _union_distinct(
        [
            df.filter(F.col(ts).isNotNull()).select(F.to_date(ts).alias("full_date"))
            for df, ts in sources
        ]
    )
    day = F.col("full_date")
    return days.select(
        hash_key("full_date").alias("date_key"),
        day,
        F.year(day).cast("bigint").alias("year"),
        F.quarter(day).cast("bigint").alias("quarter"),
        F.month(day).cast("bigint").alias("month"),
        cal.month_name(day).alias("month_name"),
        F.dayofmonth(day).cast("bigint").alias("day_of_month"),
        F.dayofweek(day).cast("bigint").alias("day_of_week"),
        cal.day_name(day).alias("day_name"),
        cal.is_weekend(day).alias("is_weekend"),
        cal.fiscal_year(day, fiscal_start).alias("fiscal_year"),
    )


def conformed_dim(sources: Sequence[DataFrame], not_null: Sequence[str] = ()) -> DataFrame:
    """Distinct rows over all sources, which share their column names; NULLs are equal."""
    return _union_distinct([_present(df, not_null) for df in sources])


def distinct_dim(
    df: DataFrame, cols: Sequence[str | Column], not_null: Sequence[str] = ()
) -> DataFrame:
    """Distinct attribute combinations of one source."""
    return _present(df, not_null).select(*cols).distinct()


def grouped_dim(
    df: DataFrame, keys: Sequence[str], attributes: Mapping[str, Column]
) -> DataFrame:
    """One row per natural key with aggregated, representative attributes."""
    return df.groupBy(*keys).agg(*[agg.alias(name) for name, agg in attributes.items()])


def representative(c: str, deterministic: bool = True) -> Column:
    """A non-NULL value of the group: the least one, or any one when that is good enough."""
    return F.min(c) if deterministic else F.any_value(c, F.lit(True))


def sequence_key(df: DataFrame, order: Sequence[str], name: str, store: Store) -> DataFrame:
    """Number the rows 1..n in ``order`` (NULLs first) without passing them through one task.

    The rows are range-partitioned and sorted by ``order``, then written with their position
    inside the range. Adding the sizes of the earlier ranges turns positions into row numbers.
    The ranges come from a sample, so they are written before they are counted: a second
    evaluation could cut them elsewhere, and each call writes a folder of its own.
    """
    position = F.monotonically_increasing_id()
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = store.helper().table("keys", name, ranged.withColumn("_position", position))
    in_range = F.col("_position").bitwiseAND((1 << 33) - 1)
    ranges = F.shiftright("_position", 33)

    # One row per range; the number of ranges is the number of write tasks.
    sizes = placed.groupBy(ranges.alias("_range")).agg(F.count("*").alias("_rows"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_range", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset")
    )
    return (
        placed.withColumn("_range", ranges)
        .join(F.broadcast(offsets), "_range")
        .select((F.col("_offset") + in_range + 1).alias(name), *df.columns)
    )


def _present(df: DataFrame, not_null: Sequence[str]) -> DataFrame:
    for c in not_null:
        df = df.filter(F.col(c).isNotNull())
    return df


def _union_distinct(frames: Sequence[DataFrame]) -> DataFrame:
    """Distinct within each source first, which keeps the final shuffle small."""
    return reduce(DataFrame.unionByName, [df.distinct() for df in frames]).distinct()

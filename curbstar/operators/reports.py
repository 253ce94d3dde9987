"""Cross-mart reports over facts and dimensions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Series:
    """A fact counted through one dimension: one series, or one per value of a label column.

    ``also`` names columns that both sides share beside the key, such as the fact's partition: a
    filter on the dimension then prunes the fact's files. ``count`` is the column with the number of
    events where rows stand for several, as in a summary.
    """

    label: str | Column
    fact: DataFrame
    dim: DataFrame
    key: str
    also: tuple[str, ...] = ()
    count: str | None = None


def series_counts(series: Sequence[Series], by: Mapping[str, str | Column]) -> DataFrame:
    """Events per dimension attribute(s) and series; facts without a dimension row drop out.

    Facts are counted per foreign key before they meet the dimension, so the join sees one row
    per key however many facts share it.
    """
    names = list(by)
    counted = []
    for s in series:
        label = F.lit(s.label) if isinstance(s.label, str) else s.label
        keys = [s.key, *s.also]
        events = _events(s.count).alias("event_count")
        per_key = s.fact.groupBy(*keys, label.alias("series")).agg(events)
        attributes = s.dim.select(*keys, *_named(by))
        counted.append(
            per_key.join(attributes, keys)
            .groupBy(*names, "series")
            .agg(F.sum("event_count").alias("event_count"))
        )
    merged = reduce(DataFrame.unionByName, counted)
    if len(counted) > 1:
        merged = merged.groupBy(*names, "series").agg(F.sum("event_count").alias("event_count"))
    return merged.orderBy(*names, "series")


def share_within(
    fact: DataFrame,
    part: tuple[DataFrame, str, str],
    by: tuple[DataFrame, str, str],
    count: str,
    share: str,
    events: str | None = None,
) -> DataFrame:
    """Count per (part, by) and its percentage of the part's total, two decimals.

    ``part`` and ``by`` are (dimension, key, attribute); ``events`` is the fact's column with the
    number of events, if a row stands for several.
    """
    (part_dim, part_key, part_attr), (by_dim, by_key, by_attr) = part, by
    counts = (
        fact.groupBy(part_key, by_key)
        .agg(_events(events).alias(count))
        .join(part_dim.select(part_key, part_attr), part_key)
        .join(by_dim.select(by_key, by_attr), by_key)
        .groupBy(part_attr, by_attr)
        .agg(F.sum(count).alias(count))
    )
    total = F.sum(count).over(Window.partitionBy(part_attr))
    percent = F.round(F.col(count) * F.lit(100.0) / total, 2)
    return counts.withColumn(share, percent).orderBy(part_attr, F.desc(share))


def total(fact: DataFrame, name: str, events: str | None = None) -> DataFrame:
    """Scorecard: the number of rows, or of the events that they stand for."""
    return fact.agg(F.coalesce(_events(events), F.lit(0)).alias(name))


def summarize(facts: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """``series, *keys, event_count``: events of all facts by their foreign keys.

    A fact without a key has NULL there. Reports by any attributes of the keys' dimensions add this
    up, and need no fact.
    """
    kinds = {f.name: f.dataType for fact in facts.values() for f in fact.schema.fields}
    parts = [
        fact.groupBy(*[k for k in keys if k in fact.columns])
        .agg(F.count("*").alias("event_count"))
        .select(
            F.lit(label).alias("series"),
            *[F.col(k) if k in fact.columns else F.lit(None).cast(kinds[k]).alias(k) for k in keys],
            "event_count",
        )
        for label, fact in facts.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def drill_down(
    summary: DataFrame, dims: Sequence[tuple[DataFrame, Sequence[str]]], by: Sequence[str]
) -> DataFrame:
    """Events of a summary by attributes of several dimensions, given with the keys they join on.

    Only dimensions that hold one of the attributes are joined, each after the summary is added up
    by the keys that are left; events without a row in one of these drop out.
    """
    used = [(dim, keys) for dim, keys in dims if set(by) & set(dim.columns) - set(keys)]
    # what the dimensions leave to the summary, such as its series
    left = [c for c in by if not any(c in dim.columns for dim, _ in used)]
    every = [k for _, keys in used for k in keys]
    found = summary.groupBy(*every, *left, "series").agg(F.sum("event_count").alias("event_count"))
    for i, (dim, keys) in enumerate(used):
        known = [c for c in by if c in dim.columns and c not in keys and c not in left]
        after = [k for _, others in used[i + 1 :] for k in others]
        found = found.join(dim.select(*keys, *known), list(keys))
        got = [c for c in by if c in found.columns]
        found = found.groupBy(*after, *got, "series").agg(F.sum("event_count").alias("event_count"))
    return found.select(*by, "series", "event_count").orderBy(*by, "series")


def _events(count: str | None) -> Column:
    return F.sum(count) if count else F.count("*")


def scorecards(facts: Mapping[str, DataFrame]) -> DataFrame:
    """Several scorecards as (metric, value) rows."""
    rows = [
        total(fact, "value").select(F.lit(name).alias("metric"), "value")
        for name, fact in facts.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def _named(by: Mapping[str, str | Column]) -> list[Column]:
    return [(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in by.items()]

"""Declarative data-quality checks, reported as failing counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


@dataclass(frozen=True)
class NotNull:
    """Fails once per row without a value."""

    table: str
    column: str


@dataclass(frozen=True)
class Unique:
    """Fails once per value that occurs more than once."""

    table: str
    column: str


@dataclass(frozen=True)
class Accepted:
    """Fails once per row with a value outside the list; NULL passes."""

    table: str
    column: str
    values: tuple[str, ...]


@dataclass(frozen=True)
class Related:
    """Fails once per row whose value is missing in the parent; NULL passes."""

    table: str
    column: str
    parent: str
    parent_column: str


Check = NotNull | Unique | Accepted | Related
NAMES = {
    NotNull: "not_null",
    Unique: "unique",
    Accepted: "accepted_values",
    Related: "relationships",
}


def run_checks(
    tables: Mapping[str, DataFrame],
    checks: Sequence[Check],
    observed: Mapping[Check, int] | None = None,
) -> DataFrame:
    """One row per check: table, column, check, number of failures.

    All row-wise checks of a table share one pass over it, and so do all its unique checks. Checks
    in ``observed`` were counted while their table was written, and need none.
    """
    known = {c: n for c, n in (observed or {}).items() if c in checks}
    rest = [c for c in checks if c not in known]
    parts = [_known(next(iter(tables.values())), known)] if known else []
    for name in dict.fromkeys(c.table for c in rest):
        row_wise = [c for c in rest if c.table == name and isinstance(c, (NotNull, Accepted))]
        if row_wise:
            parts.append(_row_wise(tables[name], row_wise))
        keys = list(dict.fromkeys(c for c in rest if c.table == name and isinstance(c, Unique)))
        if keys:
            parts.append(_duplicates(tables[name], keys))
    parts += [_result(c, _orphans(tables, c)) for c in rest if isinstance(c, Related)]
    return reduce(DataFrame.unionByName, parts)


class Observed:
    """Row-wise checks of a table, counted by the job that writes it."""

    def __init__(self, checks: Sequence[Check]):
        self.checks = [c for c in checks if isinstance(c, (NotNull, Accepted))]
        self._observation = Observation() if self.checks else None

    def watch(self, df: DataFrame) -> DataFrame:
        """``df`` to be written; put no shuffle above it, so that a task run again counts once."""
        if self._observation is None:
            return df
        counts = [F.count_if(_fails(c)).alias(f"c{i}") for i, c in enumerate(self.checks)]
        return df.observe(self._observation, *counts)

    def counts(self) -> dict[Check, int]:
        """Failures per check; known as soon as the table is written."""
        if self._observation is None:
            return {}
        found = self._observation.get
        return {c: found.get(f"c{i}") or 0 for i, c in enumerate(self.checks)}


def _known(any_table: DataFrame, counts: Mapping[Check, int]) -> DataFrame:
    rows = [F.struct(*_labels(c), F.lit(n).cast("bigint").alias("failures")) for c, n in counts.items()]
    return any_table.sparkSession.range(1).select(F.inline(F.array(*rows)))


def _row_wise(df: DataFrame, checks: Sequence[NotNull | Accepted]) -> DataFrame:
    return _one_row_each(df.agg(*[F.count_if(_fails(c)).alias(f"c{i}") for i, c in enumerate(checks)]), checks)


def _one_row_each(counts: DataFrame, checks: Sequence[Check]) -> DataFrame:
    rows = F.array(*[F.struct(*_labels(c), F.col(f"c{i}").alias("failures")) for i, c in enumerate(checks)])
    return counts.select(F.inline(rows))


def _fails(c: NotNull | Accepted) -> Column:
    if isinstance(c, NotNull):
        return F.col(c.column).isNull()
    return ~F.col(c.column).isin(list(c.values))


def _duplicates(df: DataFrame, checks: Sequence[Unique]) -> DataFrame:
    """Values that occur more than once in each column, by one exchange for all columns."""
    columns = [c.column for c in checks]
    plain = df.select(*[F.col(c).alias(f"v{i}") for i, c in enumerate(columns)])
    values = plain.columns
    per_value = plain.groupingSets([[v] for v in values], *values).agg(
        F.count("*").alias("n"), F.grouping_id(*values).alias("others")
    )
    # the columns that a row is not about are the bits set, the first column the highest
    every = (1 << len(values)) - 1
    twice = [
        (F.col("others") == every - (1 << (len(values) - 1 - i))) & F.col(v).isNotNull() & (F.col("n") > 1)
        for i, v in enumerate(values)
    ]
    return _one_row_each(
        per_value.agg(*[F.count_if(t).alias(f"c{i}") for i, t in enumerate(twice)]), checks
    )


def _orphans(tables: Mapping[str, DataFrame], c: Related) -> DataFrame:
    """Children are counted per value first, so a frequent value meets the parent only once."""
    child = (
        tables[c.table]
        .filter(F.col(c.column).isNotNull())
        .groupBy(F.col(c.column).alias("value"))
        .agg(F.count("*").alias("n"))
    )
    parent = tables[c.parent].select(F.col(c.parent_column).alias("value"))
    missing = child.join(parent, "value", "left_anti")
    return missing.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failures"))


def _labels(c: Check) -> list[Column]:
    return [
        F.lit(c.table).alias("table_name"),
        F.lit(c.column).alias("column_name"),
        F.lit(NAMES[type(c)]).alias("check_name"),
    ]


def _result(c: Check, failures: DataFrame) -> DataFrame:
    return failures.select(*_labels(c), "failures")

"""Typed projections and row filters of the staging layer."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from curbstar.functions.clean import safe_cast


def safe_project(df: DataFrame, columns: Mapping[str, str | tuple[str, str] | Column]) -> DataFrame:
    """Rename and cast: ``{out: source}``, ``{out: (source, type)}`` or ``{out: expression}``.

    Malformed values become NULL.
    """
    out = []
    for name, spec in columns.items():
        if isinstance(spec, tuple):
            value = safe_cast(*spec)
        else:
            value = F.col(spec) if isinstance(spec, str) else spec
        out.append(value.alias(name))
    return df.select(*out)


def strict_project(df: DataFrame, drop: Sequence[str], columns: Mapping[str, Column]) -> DataFrame:
    """All columns but ``drop``, then the derived ones (which may reuse a dropped name)."""
    kept = [F.col(c) for c in df.columns if c not in set(drop)]
    return df.select(*kept, *[value.alias(name) for name, value in columns.items()])


@dataclass(frozen=True)
class BadValues:
    """Rows whose text is no value of a column's type, with the least and the greatest such text."""

    rows: int
    least: str | None
    greatest: str | None


class CheckedCasts:
    """Strict casts that report all bad rows of all columns instead of the first one met.

    ``casts`` maps each new column to its text and type. Malformed text becomes NULL and is counted by
    the job that writes the table, without a further pass; ``verify`` then fails. Write where nothing
    is live yet (a build that is not published), so that a failed table is never read.
    """

    def __init__(self, casts: Mapping[str, tuple[str, str]]):
        self.casts = dict(casts)
        self._observation = Observation()

    def project(self, df: DataFrame, drop: Sequence[str] = ()) -> DataFrame:
        """``df`` without ``drop``, plus the cast columns; to be written once."""
        metrics = []
        for i, (source, to) in enumerate(self.casts.values()):
            text = F.col(source)
            bad = F.when(text.isNotNull() & safe_cast(text, to).isNull(), text)
            metrics += [F.count(bad).alias(f"n{i}"), F.min(bad).alias(f"a{i}"), F.max(bad).alias(f"z{i}")]
        watched = df.observe(self._observation, *metrics)
        cast = {name: safe_cast(F.col(source), to) for name, (source, to) in self.casts.items()}
        return strict_project(watched, [*drop, *cast], cast)

    def report(self) -> dict[str, BadValues]:
        """Bad values per column, none included; known as soon as the table is written."""
        found = self._observation.get
        return {
            name: BadValues(found.get(f"n{i}") or 0, found.get(f"a{i}"), found.get(f"z{i}"))
            for i, name in enumerate(self.casts)
        }

    def verify(self) -> None:
        """Fail if any text was malformed, naming every column."""
        bad = {name: b for name, b in self.report().items() if b.rows}
        if bad:
            raise ValueError("; ".join(
                f"{name}: {b.rows} rows are no {self.casts[name][1]}, such as {b.least!r} and {b.greatest!r}"
                for name, b in bad.items()
            ))


def require(
    df: DataFrame, not_null: Sequence[str], allowed: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """Rows with all required fields present and the listed fields within their domain."""
    for c in not_null:
        df = df.filter(F.col(c).isNotNull())
    for c, values in (allowed or {}).items():
        df = df.filter(F.col(c).isin(list(values)))
    return df

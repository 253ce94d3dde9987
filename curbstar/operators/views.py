"""Staging tables stated once, as a plan or as the SQL text of a catalog view."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbstar.functions.clean import safe_cast_sql
from curbstar.operators.dedup import dedup_latest
from curbstar.operators.project import require, safe_project


@dataclass(frozen=True)
class Sql:
    """An expression as SQL text."""

    text: str


Values = Mapping[str, str | tuple[str, str] | Sql]


@dataclass(frozen=True)
class Staging:
    """The latest valid version of each record of a raw extract.

    ``versions`` holds what decides between versions, cast where order or validity need it; ``columns``
    are the table's own, computed on the kept rows. Both map a name to a source column, to a source
    column with the type it is safely cast to, or to SQL. ``latest`` is the SQL of the order.
    """

    versions: Values
    required: Sequence[str]
    key: str
    latest: str
    columns: Values
    allowed: Mapping[str, Sequence[str]] = field(default_factory=dict)

    @property
    def tiebreak(self) -> list[str]:
        return [c for c in self.versions if c != self.key]

    def plan(self, raw: DataFrame, only: Sequence[str] | None = None) -> DataFrame:
        """Only what decides between versions is cast before the shuffle, the rest on the kept rows.

        With ``only``, the table has these of its columns, and fewer texts are moved.
        """
        wanted = self.columns if only is None else {c: self.columns[c] for c in only}
        valid = require(safe_project(raw, _columns(self.versions)), self.required, self.allowed)
        latest = dedup_latest(valid, [self.key], F.expr(self.latest), self.deciding(wanted))
        return safe_project(latest, _columns(wanted))

    def deciding(self, wanted: Values) -> list[str]:
        """The tiebreak as far as the last column that ``wanted`` reads.

        Versions that are equal so far hold the same wanted values, so any of them may be kept.
        """
        order = self.tiebreak
        while order and not any(_may_read(value, order[-1]) for value in wanted.values()):
            order = order[:-1]
        return order

    def sql(self, source: str) -> str:
        """The same as SQL over a table, a view, or files (``parquet.`path` ``)."""
        valid = [f"{quoted(c)} IS NOT NULL" for c in self.required] + [
            f"{quoted(c)} IN ({', '.join(literal(v) for v in values)})" for c, values in self.allowed.items()
        ]
        order = ", ".join([f"{self.latest} DESC NULLS LAST", *map(quoted, self.tiebreak)])
        return f"""SELECT {_list(self.columns)}
FROM (
  SELECT *, row_number() OVER (PARTITION BY {quoted(self.key)} ORDER BY {order}) AS _version_rank
  FROM (SELECT {_list(self.versions)} FROM {source}) AS versions
  WHERE {" AND ".join(valid) or "true"}
) AS ranked
WHERE _version_rank = 1"""


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def classify_prefix_sql(text: str, rules: Sequence[tuple[Sequence[str], str]], default: str) -> str:
    """``functions.clean.classify_prefix`` as SQL: the first rule with a matching prefix wins."""
    cases = " ".join(
        f"WHEN {' OR '.join(f'startswith(upper({text}), {literal(p)})' for p in prefixes)} THEN {literal(label)}"
        for prefixes, label in rules
    )
    return f"CASE {cases} ELSE {literal(default)} END"


def _may_read(value: str | tuple[str, str] | Sql, column: str) -> bool:
    """Whether the value may read the column; of SQL, whether the name occurs in its text at all."""
    if isinstance(value, Sql):
        return quoted(column)[1:-1].lower() in value.text.lower()
    return (value[0] if isinstance(value, tuple) else value).lower() == column.lower()


def _columns(values: Values) -> dict:
    return {name: F.expr(v.text) if isinstance(v, Sql) else v for name, v in values.items()}


def _list(values: Values) -> str:
    out = []
    for name, value in values.items():
        if isinstance(value, Sql):
            text = value.text
        else:
            text = safe_cast_sql(quoted(value[0]), value[1]) if isinstance(value, tuple) else quoted(value)
        out.append(f"{text} AS {quoted(name)}")
    return ", ".join(out)

"""A plan: named tables that build on each other."""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from threading import RLock

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbstar.operators.quality import Check, Observed, run_checks
from curbstar.sources.store import Store

# Builds a fact from its staged rows and its dimensions by name; a dimension that is left out
# leaves out its foreign key.
FactBuilder = Callable[[DataFrame, Mapping[str, DataFrame]], DataFrame]


class Plan(ABC):
    """Tables are built on first use; dimensions and facts are written.

    Staging tables are written where all their columns are read: in ``build`` and for a whole fact.
    A single dimension or a report reads few of their columns, so it is planned straight from the
    extracts; a report that reads a staging table several times may ``gather`` the columns it reads.
    ``sources`` are the raw extracts by name.
    """

    tables: list[str]
    # Fact table: staging table, builder, dimensions.
    facts: Mapping[str, tuple[str, FactBuilder, list[str]]]
    # Written facts that are partitioned: column name and what it holds, as SQL. The column is beside the
    # fact's own ones and only in ``partitioned``.
    partitions: Mapping[str, tuple[str, str]] = {}

    # Events of all facts by their foreign keys, if the plan keeps such a table: reports then read it
    # in place of the facts.
    summary: str | None = None

    def __init__(self, store: Store, sources: Mapping[str, DataFrame]):
        self.store = store
        self.sources = sources
        self._built: dict[str, DataFrame] = dict(sources)
        self._partitioned: dict[str, DataFrame] = {}
        self._gathered: dict[str, DataFrame] = {}
        self._watched: Sequence[Check] = ()
        self._observed: dict[str, Observed] = {}
        named = (*sources, *self.tables, *([self.summary] if self.summary else ()))
        self._locks = {name: RLock() for name in named}

    @classmethod
    def open(cls, store: Store) -> Plan:
        """The plan over a warehouse that is built already: its reports read the finished marts."""
        plan = cls(store, {})
        staging = {staged for staged, _, _ in cls.facts.values()}
        for name in cls.tables:
            if name not in staging:
                plan._keep(name, store.read(plan.layer(name), name))
        if cls.summary and store.has(plan.layer(cls.summary), cls.summary):
            plan._keep(cls.summary, store.read(plan.layer(cls.summary), cls.summary))
        return plan

    @property
    def summarized(self) -> bool:
        return self.summary in self._built

    def _keep(self, name: str, written: DataFrame) -> None:
        if name in self.partitions:
            self._partitioned[name] = written
            written = written.drop(self.partitions[name][0])
        self._built[name] = written

    def partitioned(self, name: str) -> tuple[DataFrame, tuple[str, ...]]:
        """The written fact with its partition column, and that column's name; none if not written."""
        if name in self._partitioned:
            return self._partitioned[name], (self.partitions[name][0],)
        return self.fact(name), ()

    @abstractmethod
    def plan_other(self, name: str) -> DataFrame:
        """A table that is not a fact, as a plan over its written inputs."""

    @abstractmethod
    def layer(self, name: str) -> str:
        """The layer that the table belongs to."""

    def plan(self, name: str) -> DataFrame:
        """The table as a plan, itself not written."""
        return self.fact(name, *self.facts[name][2]) if name in self.facts else self.plan_other(name)

    def fact(self, name: str, *dims: str) -> DataFrame:
        """The written fact; before it is written, a plan of it with these dimensions' keys only.

        The staged rows are written only where the fact takes all its keys.
        """
        if name in self._built:
            return self._built[name]
        staged, builder, every = self.facts[name]
        whole = set(dims) >= set(every)
        rows = self.table(staged) if whole else self.staged(staged)[0]
        return builder(rows, dict(zip(dims, self.together(*dims))))

    def staged(self, *names: str, columns: Sequence[str] | None = None) -> list[DataFrame]:
        """Staging tables as written, or as plans where they are not; ``columns`` are all that is read."""
        return [self._staged(name, columns) for name in names]

    def _staged(self, name: str, columns: Sequence[str] | None) -> DataFrame:
        if name in self._built:
            return self._built[name]
        if columns is None:
            return self.plan(name)
        if name in self._gathered and set(columns) <= set(self._gathered[name].columns):
            return self._gathered[name]
        return self.plan_columns(name, columns)

    def plan_columns(self, name: str, columns: Sequence[str]) -> DataFrame:
        """Some columns of a staging table as a plan."""
        return self.plan(name).select(*columns)

    def gather(self, name: str, columns: Sequence[str]) -> None:
        """Write these columns of a staging table aside, unless they are written already.

        Whoever reads no others finds them there, so the extract is read and its versions are moved once.
        """
        with self._locks[name]:
            written = self._built.get(name, self._gathered.get(name))
            if written is None or not set(columns) <= set(written.columns):
                df = self.plan_columns(name, columns)
                self._gathered[name] = self.store.helper().table("staging", name, df)

    def table(self, name: str) -> DataFrame:
        """The written table, or the raw extract of that name."""
        with self._locks[name]:
            if name not in self._built:
                df, by = self.plan(name), ()
                if name in self.partitions:
                    column, value = self.partitions[name]
                    # files of a proper size in each partition; large partitions are split
                    df, by = df.withColumn(column, F.expr(value)).hint("rebalance", column), (column,)
                self._observed[name] = Observed([c for c in self._watched if c.table == name])
                df = self._observed[name].watch(df)
                self._keep(name, self.store.table(self.layer(name), name, df, by))
            return self._built[name]

    def together(self, *names: str) -> list[DataFrame]:
        """Several written tables; Spark runs the jobs of those not yet written side by side."""
        with ThreadPoolExecutor(max(len(names), 1)) as pool:
            return list(pool.map(self.table, names))

    def build(self, watch: Sequence[Check] = (), summarize: bool = True) -> dict[str, DataFrame]:
        """Build and write all tables, staging first, and publish them together.

        Row-wise checks among ``watch`` are counted by the jobs that write their tables. The summary,
        if the plan has one, is added up from the written facts.
        """
        self._watched = watch
        self.together(*{staged for staged, _, _ in self.facts.values()})
        built = dict(zip(self.tables, self.together(*self.tables)))
        if self.summary and summarize:
            self.table(self.summary)
        self.store.publish()
        return built

    def observed(self) -> dict[Check, int]:
        """Failures of the checks that were counted while tables were written."""
        return {c: n for o in self._observed.values() for c, n in o.counts().items()}

    def build_checked(self, checks: Sequence[Check]) -> DataFrame:
        """Build everything and report all checks; only those across rows read the tables again."""
        return run_checks(self.build(checks, summarize=False), checks, self.observed())

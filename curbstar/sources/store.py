"""Sinks: every table is rebuilt in full and read back, so later plans see its real size."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from curbstar.session import new_scratch


class Store:
    """Tables by layer: a folder per layer under ``root``, or a catalog database per layer."""

    def __init__(self, spark: SparkSession, root: str | None = None, catalog: bool = False):
        if root is None and not catalog:
            raise ValueError("a store needs a folder or the catalog")
        self.spark = spark
        self.root = root
        self.catalog = catalog

    @classmethod
    def scratch(cls, spark: SparkSession) -> Store:
        """A new private folder in the shared scratch space, removed with the session."""
        return cls(spark, new_scratch(spark, "tables"))

    def helper(self) -> Store:
        """For tables that only help to build others: never in the user's catalog or folder."""
        return Store.scratch(self.spark)

    def table(
        self, layer: str, name: str, df: DataFrame, partition_by: Sequence[str] = ()
    ) -> DataFrame:
        """Write ``df`` as a table, replacing an older one, and return the written table."""
        writer = df.write.mode("overwrite").format("parquet")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if self.catalog:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
            with self._replacing(f"{layer}.{name}", "VIEW"):
                writer.saveAsTable(f"{layer}.{name}")
            return self.spark.table(f"{layer}.{name}")
        path = self.path(layer, name)
        writer.save(path)
        return self.spark.read.schema(df.schema).parquet(path).select(*df.columns)

    def path(self, layer: str, name: str) -> str:
        """The folder that a table is written to."""
        return f"{self.root}/{layer}/{name}"

    def publish(self) -> None:
        """Make all tables written so far the live ones; here every table is live once written."""

    def land(self, layer: str, name: str, df: DataFrame, by: Sequence[str], buckets: int) -> DataFrame:
        """Write ``df`` to the catalog in buckets of ``by``, one sorted file each.

        Later windows, joins and counts by these columns find equal keys in one task without a
        shuffle: rows move once, when they land, however often they are read. A store with a folder
        keeps the files there under a name of its own; choose ``buckets`` so that a bucket fits a task.
        """
        writer = (
            df.repartition(buckets, *by).write.mode("overwrite").format("parquet")
            .bucketBy(buckets, *by).sortBy(*by)
        )
        if self.catalog:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
            table = f"{layer}.{name}"
        else:
            table = f"{layer}_{name}_{uuid.uuid4().hex}"
            writer = writer.option("path", self.path(layer, table))
        writer.saveAsTable(table)
        return self.spark.table(table)

    def read(self, layer: str, name: str) -> DataFrame:
        """A table written earlier, by any session."""
        if self.catalog:
            return self.spark.table(f"{layer}.{name}")
        return self.spark.read.parquet(f"{self.root}/{layer}/{name}")

    def has(self, layer: str, name: str) -> bool:
        """Whether ``read`` would find the table."""
        if self.catalog:
            return self.spark.catalog.tableExists(f"{layer}.{name}")
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path(layer, name))
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path)

    def view(self, name: str, df: DataFrame) -> DataFrame:
        """Publish ``df`` as a view; nothing is computed."""
        df.createOrReplaceTempView(name)
        return df


    def persistent_view(self, layer: str, name: str, sql: str) -> DataFrame:
        """Keep ``sql`` as a view in the catalog, for every session that shares it.

        It reads what its sources hold when it is read. A store with a folder gives the view a name of
        its own, so that none of the user's is replaced.
        """
        if self.catalog:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
            view = f"{layer}.{name}"
        else:
            view = f"{layer}_{name}_{uuid.uuid4().hex}"
        with self._replacing(view, "TABLE"):
            self.spark.sql(f"CREATE OR REPLACE VIEW {view} AS {sql}")
        return self.spark.table(view)

    @contextmanager
    def _replacing(self, relation: str, kind: str) -> Iterator[None]:
        """A TABLE gives way to a view of its name, a VIEW to a table; it is back if making that fails."""
        catalog = self.spark.catalog
        if not catalog.tableExists(relation) or (catalog.getTable(relation).tableType == "VIEW") != (kind == "VIEW"):
            yield
            return
        aside = f"{relation}_{uuid.uuid4().hex}"
        self.spark.sql(f"ALTER {kind} {relation} RENAME TO {aside}")
        try:
            yield
        except BaseException:
            self.spark.sql(f"ALTER {kind} {aside} RENAME TO {relation}")
            raise
        self.spark.sql(f"DROP {kind} {aside}")


class Warehouse(Store):
    """Tables that stay readable while they are rebuilt.

    Each build writes to a folder of its own, ``builds/<build>/<layer>/<table>``. ``publish`` makes its
    tables live all at once by adding one small file, the next ``manifests/<number>.json``, which names
    the folder and the schema of every live table; tables that the build did not write stay as they
    were. A reader pins the latest manifest when it first reads and keeps to it, whatever is published
    meanwhile. A build that ends half-way adds no manifest, so nothing of it is ever seen.
    """

    def __init__(self, spark: SparkSession, root: str, version: int | None = None):
        super().__init__(spark, root.rstrip("/"))
        self.build = f"{int(time.time()):012d}-{uuid.uuid4().hex}"
        self._made: dict[str, dict] = {}
        self._pinned = None if version is None else self._manifest(version)

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/builds/{self.build}/{layer}/{name}"

    def table(
        self, layer: str, name: str, df: DataFrame, partition_by: Sequence[str] = ()
    ) -> DataFrame:
        written = super().table(layer, name, df, partition_by)
        self._made[f"{layer}/{name}"] = {
            "folder": f"builds/{self.build}/{layer}/{name}",
            "schema": written.schema.jsonValue(),
        }
        return written

    def read(self, layer: str, name: str) -> DataFrame:
        if not self.has(layer, name):
            raise LookupError(f"{layer}/{name} is not published in {self.root}")
        entry = self._pinned[f"{layer}/{name}"]
        schema = T.StructType.fromJson(entry["schema"])
        found = self.spark.read.schema(schema).parquet(f"{self.root}/{entry['folder']}")
        return found.select(*schema.fieldNames())

    def has(self, layer: str, name: str) -> bool:
        if self._pinned is None:
            self.refresh()
        return f"{layer}/{name}" in self._pinned

    def refresh(self) -> None:
        """Pin the manifest that is the latest now."""
        versions = self.versions()
        self._pinned = self._manifest(versions[-1]) if versions else {}

    def versions(self) -> list[int]:
        """Numbers of all manifests, oldest first."""
        fs, path = self._at("manifests")
        names = [f.getPath().getName() for f in fs.listStatus(path)] if fs.exists(path) else []
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def publish(self) -> None:
        """Another build may publish at the same time: whoever finds the number taken takes the next,
        on top of what the other has published."""
        if not self._made:
            return
        while True:
            versions = self.versions()
            number = versions[-1] + 1 if versions else 1
            live = {**(self._manifest(versions[-1]) if versions else {}), **self._made}
            if self._add_manifest(number, live):
                self._pinned = live
                return

    def retire(self, keep: int = 2, older_than: float = 86_400) -> list[str]:
        """Delete builds that none of the last ``keep`` manifests names and that began ``older_than``
        seconds ago or more, so that running builds stay."""
        named = {
            entry["folder"].split("/")[1]
            for version in self.versions()[-keep:]
            for entry in self._manifest(version).values()
        }
        fs, path = self._at("builds")
        builds = [f.getPath().getName() for f in fs.listStatus(path)] if fs.exists(path) else []
        old = f"{int(time.time() - older_than):012d}"
        gone = [b for b in builds if b not in named and b[:12] <= old]
        for build in gone:
            fs.delete(self._at(f"builds/{build}")[1], True)
        return gone

    def _at(self, name: str):
        """A file or folder under the root, with its file system."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), path

    def _manifest(self, version: int) -> dict[str, dict]:
        text = self.spark.read.text(f"{self.root}/manifests/{version:012d}.json", wholetext=True)
        return json.loads(text.first()[0])

    def _add_manifest(self, number: int, live: dict[str, dict]) -> bool:
        """Write aside, then rename, which fails if the number is taken: no reader meets half a file."""
        jvm = self.spark.sparkContext._jvm
        fs, aside = self._at(f"manifests/_{self.build}")
        out = fs.create(aside, True)
        out.write(json.dumps(live, indent=1).encode())
        out.close()
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            aside.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration()
        )
        kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(kind, 1)
        options[0] = kind.NONE
        try:
            files.rename(aside, self._at(f"manifests/{number:012d}.json")[1], options)
        except Py4JJavaError as error:
            if "FileAlreadyExists" not in str(error.java_exception):
                raise
            fs.delete(aside, False)
            return False
        return True

"""Session helper and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: str | int = "*", app: str = "curbstar", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own session."""
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "12g",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for name, value in settings.items():
        builder = builder.config(name, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def scratch_root(spark: SparkSession) -> str:
    """Folder for tables written to cut lineage: the one named in ``spark.checkpoint.dir``.

    Only a local session without that setting falls back to a temporary folder; on a cluster such
    a folder would be private to one machine, so a missing setting is an error there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="curbstar-"))
    return spark.sparkContext.getCheckpointDir()


def new_scratch(spark: SparkSession, kind: str) -> str:
    """A new folder in the shared scratch space, removed when the session's JVM ends."""
    folder = f"{scratch_root(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder

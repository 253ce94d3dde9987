"""Readers for the raw extracts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbstar.sources.schemas import RAW_TABLES, all_text

# Text rows of a task, at CELL_BYTES a cell, take about TASK_BYTES of memory where they are sorted.
TASK_BYTES = 256 * 1024 * 1024
CELL_BYTES = 32
# Up to so many partitions a shuffle streams its rows to files (spark.shuffle.sort.bypassMergeThreshold);
# beyond, a map task gathers them in memory. Only tasks of 4 * TASK_BYTES are worth that.
STREAMED_TASKS = 200


def text_tasks(rows: int, columns: int) -> int:
    """In how many tasks to handle ``rows`` of ``columns`` texts, so that no task takes much memory."""
    wanted = -(-rows * columns * CELL_BYTES // TASK_BYTES)
    return max(min(wanted, STREAMED_TASKS), wanted // 4, 1)


def read_raw(
    spark: SparkSession,
    table: str,
    path: str,
    fmt: str = "parquet",
    extra: Sequence[str] = (),
    **options,
) -> DataFrame:
    """One raw extract as an all-text DataFrame, from files of any format Spark reads.

    Columns beyond the declared ones come along. Parquet and ORC files hold texts in far fewer bytes than
    memory does, so a usual share of such a file may be too much for one task, and its rows are spread
    over more. JSON files do not list their columns, so there
    ``extra`` names those wanted, which spares a pass over the data.
    """
    reader = spark.read.format(fmt).options(**options)
    if fmt == "json":
        reader = reader.schema(all_text([*RAW_TABLES[table], *extra]))
    elif fmt == "csv":
        # Names come from the header line: a schema would go by position instead.
        reader = reader.option("header", True)
    raw = as_text(reader.load(path), table)
    if fmt in ("parquet", "orc"):
        # their footers hold the number of rows
        tasks = text_tasks(raw.count(), len(raw.columns))
        if raw.rdd.getNumPartitions() < tasks:
            # by the whole row: keys may be missing or frequent
            return raw.repartition(tasks, *raw.columns)
    return raw


def read_raw_table(spark: SparkSession, table: str, database: str) -> DataFrame:
    """One raw extract from a catalog table."""
    return as_text(spark.table(f"{database}.{table}"), table)


def as_text(df: DataFrame, table: str) -> DataFrame:
    """The extract's declared columns, then all others, each as text."""
    declared = RAW_TABLES[table]
    others = [c for c in df.columns if c.lower() not in {d.lower() for d in declared}]
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in (*declared, *others)])

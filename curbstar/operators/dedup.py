"""Keep-latest deduplication of republished records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "_version_rank"


def dedup_latest(
    df: DataFrame,
    keys: Sequence[str | Column],
    latest: Column,
    tiebreak: Sequence[str | Column],
) -> DataFrame:
    """One row per key: the one with the greatest ``latest``, ties settled by ``tiebreak``.

    Filter before calling, so that only valid versions compete. Spark keeps one row per key and
    map task before the shuffle, so a key with very many versions does not overload a reducer.
    """
    order = [latest.desc_nulls_last(), *tiebreak]
    ranked = df.withColumn(_RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col(_RANK) == 1).drop(_RANK)

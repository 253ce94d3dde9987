"""Nearest neighbours by cosine: collision-counting hashing over sorted projections.

Rows are dealt by hash into blocks of bounded size, and so are the queries; every block of rows
indexes itself and answers every block of queries. The index of a block is one sorted array of
projections per random direction. A query opens a window around its own projection in each array, by
binary search, and counts how often it meets each row; all windows widen together (virtual rehashing),
and only what they gain on either side is counted anew, until enough rows were met in most directions.
Only those rows are verified, by the exact cosine in double precision, and the best of all blocks are
merged. Windows end up holding the whole block, so a small block is searched in full.

Defined results: vectors that are null, zero, or hold null or non-finite components take no part, as
rows or as queries; ties go to the smaller id; a query meets every row but those with its own id;
fewer candidates than ``k`` give all of them; lengths must agree, and rows of a length other than a
query's are not its candidates; repeated rows count once; of rows that share an id but not the vector,
each takes part, and the id's best score counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbstar.llm.common import Scratch

#: Directions, the share of them in which a row must collide, and rows verified per query and block.
DIRECTIONS, SHARE, VERIFIED = 128, 0.6, 320
BLOCK_ROWS, BLOCK_QUERIES = 4096, 1024
#: Width of the first windows, as a share of the block's spread, and the factor of each step.
FIRST_WIDTH, WIDEN = 0.6, 1.2


class Block:
    """Rows of one length with a sorted array of projections for each direction."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids, self.rows = ids, rows
        self.norms = np.sqrt((rows * rows).sum(axis=1))
        generator = np.random.Generator(np.random.PCG64(rows.shape[1]))
        self.directions = generator.standard_normal((rows.shape[1], DIRECTIONS))
        spots = ((rows / self.norms[:, None]) @ self.directions).T
        self.order = np.argsort(spots, axis=1, kind="stable")
        self.sorted = np.take_along_axis(spots, self.order, axis=1)
        self.spread = spots.std(axis=1) + 1e-12
        self.one_row_each = len(np.unique(ids)) == len(ids)

    def edges(self, centres: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
        """Where each query's windows of a step begin and end in the sorted arrays."""
        reach = FIRST_WIDTH * WIDEN**step * self.spread
        edges = np.empty((2, *centres.shape), np.int64)
        # in rising order, which a binary search answers much faster
        rising = np.argsort(centres, axis=0)
        for d, line in enumerate(self.sorted):
            to = centres[rising[:, d], d]
            edges[0, rising[:, d], d] = np.searchsorted(line, to - reach[d], "left")
            edges[1, rising[:, d], d] = np.searchsorted(line, to + reach[d], "right")
        return edges[0], edges[1]

    def met(self, low: list[int], high: list[int]) -> np.ndarray:
        """How many of the stretches, one or more of each direction in turn, hold each row."""
        turns = len(low) // DIRECTIONS
        rows = [
            self.order[d // turns, a:b] for d, (a, b) in enumerate(zip(low, high)) if a < b
        ]
        return np.bincount(np.concatenate(rows), minlength=len(self.ids)) if rows else 0

    def search(self, own: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[int, int, float]]:
        """The best ``k`` ids of the block for each query, with its id and their cosine."""
        sizes = np.sqrt((queries * queries).sum(axis=1))
        centres = (queries / sizes[:, None]) @ self.directions
        need = int(np.ceil(SHARE * DIRECTIONS))
        opened: list[tuple[np.ndarray, np.ndarray]] = []
        for q in range(len(queries)):
            others = self.ids != own[q]
            wanted = min(VERIFIED, self._count(np.flatnonzero(others)))
            counts, step, close = np.zeros(len(self.ids), np.int64), 0, np.zeros(0, np.int64)
            while self._count(close) < wanted:
                if step == len(opened):
                    opened.append(self.edges(centres, step))
                low, high = (edge[q] for edge in opened[step])
                if step:
                    # what the windows gained on both sides
                    low = np.stack([low, opened[step - 1][1][q]], axis=1).ravel()
                    high = np.stack([opened[step - 1][0][q], high], axis=1).ravel()
                counts += self.met(low.tolist(), high.tolist())
                close = np.flatnonzero((counts >= need) & others)
                step += 1
            cosine = (self.rows[close] * queries[q]).sum(axis=1) / (self.norms[close] * sizes[q])
            best = np.lexsort((self.ids[close], -cosine))
            if not self.one_row_each:
                best = best[np.sort(np.unique(self.ids[close[best]], return_index=True)[1])]
            for at in best[:k]:
                yield int(own[q]), int(self.ids[close[at]]), float(cosine[at])

    def _count(self, rows: np.ndarray) -> int:
        return len(rows) if self.one_row_each else len(np.unique(self.ids[rows]))


def _answer(k: int):
    def answer(key, queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[int, int, float]] = []
        if len(queries) and len(rows):
            for size, part in rows.groupby(rows["vector"].map(len)):
                asked = queries[queries["vector"].map(len) == size]
                if len(asked):
                    block = Block(
                        part["vec_id"].to_numpy(), np.stack(part["vector"].to_numpy()).astype(np.float64)
                    )
                    wanted = np.stack(asked["vector"].to_numpy()).astype(np.float64)
                    found += block.search(asked["query_id"].to_numpy(), wanted, k)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    return answer


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest rows of each query, nearest first."""
    scratch = Scratch(vectors.sparkSession)
    numbers = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    valid = (
        F.col(id_col).isNotNull()
        & F.col(vector_col).isNotNull()
        & F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
        & F.exists("vector", lambda x: x != 0)
    )
    rows = scratch.write(
        "rows",
        vectors.withColumn("vector", numbers).where(F.coalesce(valid, F.lit(False))).select(
            F.col(id_col).cast("long").alias("vec_id"), "vector", is_query.alias("is_query")
        ).groupBy("vec_id", "vector").agg(F.max("is_query").alias("is_query")),
    )
    counts = rows.agg(F.count("*"), F.count(F.when(F.col("is_query"), 1))).first()
    row_blocks = max(1, -(-counts[0] // BLOCK_ROWS))
    query_blocks = max(1, -(-counts[1] // BLOCK_QUERIES))

    def dealt(df: DataFrame, own: str, blocks: int, other: str, others: int) -> DataFrame:
        every = F.explode(F.expr(f"sequence(0L, {others - 1}L)"))
        return df.withColumn(own, F.pmod(F.xxhash64(*df.columns), F.lit(blocks))).withColumn(
            other, every
        )

    queries = rows.where("is_query").select(F.col("vec_id").alias("query_id"), "vector")
    asked = dealt(queries, "query_block", query_blocks, "row_block", row_blocks)
    base = dealt(rows.select("vec_id", "vector"), "row_block", row_blocks, "query_block", query_blocks)
    found = (
        asked.groupBy("row_block", "query_block")
        .cogroup(base.groupBy("row_block", "query_block"))
        .applyInPandas(_answer(k), "query_id long, vec_id long, score double")
    )
    # dealt by query once, for the id's best score and for the ranks
    found = found.repartition("query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    nearest_first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(nearest_first))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )

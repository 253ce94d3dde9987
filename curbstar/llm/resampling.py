"""Quality by importance resampling: texts that look like the target are likelier to be drawn.

Words and word pairs are hashed into buckets. One generative model counts them in target texts
(those labelled as good), one in all texts. A text's log importance weight is the sum of the log
ratios of its features; with Gumbel noise added, the largest keys are a sample without replacement
in proportion to the weights.

Defined results: null, empty or wordless texts have no features and weight 0; without target texts
all weights are 0; equal ids draw equal noise, so repeated rows stand or fall together, and all rows
that tie with the last one drawn are drawn; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbstar.llm.collocations import KeyFilter
from curbstar.llm.common import (
    RollingHash, Scratch, lower_ascii, mix, passes, utf8, word_bounds,
)

BUCKET_BITS = 16
SMOOTHING = 1.0

_BUCKETS = 1 << BUCKET_BITS
_HASH = RollingHash(81)


def feature_buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words and pairs, ordered by text, and where each text's begin."""
    data = lower_ascii(data)
    starts, ends, firsts = word_bounds(data, offsets)
    word = _HASH.spans(_HASH.sums(data), starts, ends)
    pair = mix(word[:-1] * np.uint64(0x9E3779B97F4A7C15) + word[1:]) if len(word) else word
    shift = np.uint64(64 - BUCKET_BITS)
    both = np.zeros((len(word), 2), np.int64)
    both[:, 0] = (word >> shift).astype(np.int64)
    both[: len(pair), 1] = (pair >> shift).astype(np.int64)
    last = firsts[1:][firsts[1:] > firsts[:-1]] - 1
    valid = np.ones((len(word), 2), bool)
    valid[last, 1] = False
    marks = 2 * firsts - np.concatenate([[0], np.cumsum(firsts[1:] > firsts[:-1])])
    return both[valid], marks


def _counts(texts: DataFrame) -> np.ndarray:
    """Features of all texts, by bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(_BUCKETS, np.int64)
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for _, _, part, marks in passes(data, offsets):
                counts += np.bincount(feature_buckets(part, marks)[0], minlength=_BUCKETS)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], ["bucket", "n"])

    sums = texts.select("text").mapInArrow(count, "bucket long, n long")
    counts = np.zeros(_BUCKETS)
    for bucket, n in sums.groupBy("bucket").agg(F.sum("n")).collect():
        counts[bucket] = n  # a row per bucket
    return counts


def _of_ids(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``text`` of the documents with these ids.

    A bit filter of fixed size lets their texts through and few others, so that hardly more than they
    is moved; the join that settles it takes one plan at every size.
    """
    known = KeyFilter.of(ids.select(F.xxhash64("doc_id").alias("key")))

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy().view(np.uint64)
            yield batch.filter(pa.array(known.has(keys))).select(["doc_id", "text"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.where("doc_id is not null").select(
        F.xxhash64("doc_id").alias("key"), "doc_id", "text"
    ).mapInArrow(likely, f"doc_id {kind}, text string")
    return texts.hint("merge").join(ids, "doc_id", "left_semi").select("text")


def log_ratios(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    if not target.sum():
        return np.zeros(len(target))
    prior = (raw + SMOOTHING) / (raw + SMOOTHING).sum()
    weight = SMOOTHING * len(target)
    return np.log((target + weight * prior) / (target.sum() + weight)) - np.log(prior)


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, n_features, log_weight, gumbel_key`` of every document."""
    good = labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()
    target, raw = _counts(_of_ids(docs, good)), _counts(docs)
    ratios = docs.sparkSession.sparkContext.broadcast(log_ratios(target, raw))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            sizes, weights = [np.zeros(0, np.int64)], [np.zeros(0)]
            for _, _, part, marks in passes(data, offsets):
                buckets, cuts = feature_buckets(part, marks)
                sums = np.concatenate([[0.0], np.cumsum(ratios.value[buckets])])
                sizes.append(np.diff(cuts))
                weights.append(sums[cuts[1:]] - sums[cuts[:-1]])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.concatenate(sizes)),
                 pa.array(np.concatenate(weights))],
                ["doc_id", "n_features", "log_weight"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    weighed = docs.select("doc_id", "text").mapInArrow(
        weigh, f"doc_id {kind}, n_features long, log_weight double"
    )
    chance = (F.xxhash64(F.lit("gumbel"), "doc_id") / 2.0**64 + 0.5) * (1 - 2e-9) + 1e-9
    return weighed.withColumn("gumbel_key", F.col("log_weight") - F.log(-F.log(chance)))


def kth_largest(keys: DataFrame, column: str, k: int) -> float:
    """The ``k``-th largest value of a column, by narrowing histograms of bounded size."""
    low, high = keys.agg(F.min(column), F.max(column)).first()
    above = 0
    while low < high:
        width = (high - low) / 4096
        bin_of = F.least(F.floor((F.col(column) - low) / width), F.lit(4095)).cast("int")
        bins = (
            keys.where(F.col(column).between(low, high))
            .groupBy(bin_of.alias("bin"))
            .agg(F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high"))
            .orderBy(F.desc("bin"))
            .collect()
        )
        for row in bins:
            if above + row.n >= k:
                break
            above += row.n
        if (row.low, row.high) == (low, high):
            break
        low, high = row.low, row.high
    return low


def resample(docs: DataFrame, labels: DataFrame, share: float | None = None) -> DataFrame:
    """Scores with ``kept``: the draw of ``share`` of all documents, by default the share of good
    ones among the labelled."""
    scratch = Scratch(docs.sparkSession)
    scored = scratch.write("scored", score(docs, labels))
    if share is None:
        rated = labels.where("quality in (0, 1)").agg(F.avg("quality")).first()[0]
        share = 1.0 if rated is None else rated
    count = scored.count()
    k = round(share * count)
    if not k:
        return scored.withColumn("kept", F.lit(False))
    least = kth_largest(scored, "gumbel_key", k)
    return scored.withColumn("kept", F.col("gumbel_key") >= least)

"""Toxicity of texts: subword-bag embeddings averaged into a linear softmax.

A word is the bag of its character n-grams (of 3 to 8 bytes, with its edges) and itself, hashed into one
embedding table, so an unseen misspelling shares vectors with the words it resembles. Words are
averaged over windows of a few words, each window goes through a linear softmax, and a text's margin is
the mean of its windows' margins, each weighed by the exponential of itself, so that toxic windows count
most; the longer the clean rest, the more of them it takes. Embeddings and softmax are trained jointly in numpy, on the driver, on a
bounded sample of labelled texts. Scoring needs one number per bucket (the embedding times the
difference of the softmax's columns) and runs over whole texts in the tasks.

Defined results: null, empty or wordless texts get the score of an empty window; without labels of
both kinds every score is 0.5 and nothing is rejected; a document with several label rows counts as
toxic if one of them says so; repeated rows get equal scores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbstar.llm.common import PASS_BYTES, RollingHash, passes, utf8, word_bounds

BUCKETS, DIMENSIONS = 1 << 21, 8
NGRAMS = (3, 4, 5, 6, 7, 8)
WINDOW_WORDS = 2
#: Labelled texts of each kind that training takes, by hash of the id.
SAMPLE_ROWS = 2000
#: Texts that must hold a bucket before it is learnt; how strongly pooling prefers the worst window.
LEAST_TEXTS, SHARPNESS = 6, 1.0
STEPS, RATE, DECAY = 50, 0.1, 1e-7
THRESHOLD = 0.7
#: Kinds of words whose features, and buckets whose embeddings, training works on at a time.
PART_KINDS, PART_BUCKETS = 20_000, 1 << 15

_HASH = RollingHash(31)
_LETTER = np.arange(256, dtype=np.uint8)
_LETTER[ord("A") : ord("Z") + 1] += 32
_LETTER[[c for c in range(128) if not chr(c).isalnum()]] = 0x20


def _tokens(texts: list[bytes]):
    """The texts in lower case with single bytes as edges; starts and ends of words; each text's
    first word (and the end of the last)."""
    data = _LETTER[np.frombuffer(b" " + b" ".join(texts) + b" ", np.uint8)]
    marks = np.cumsum([1] + [len(t) + 1 for t in texts])
    marks[-1] = len(data)
    starts, ends, _ = word_bounds(data, np.array([0, len(data)]))
    return data, starts, ends, np.searchsorted(starts, marks)


def _features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """Bucket of each feature, and the word each belongs to."""
    sums = _HASH.sums(data)
    shift = np.uint64(64 - BUCKETS.bit_length() + 1)
    before = np.concatenate([[0], np.cumsum(data == 0x20)])
    buckets, places = [], []
    for n in NGRAMS:
        at = np.arange(max(0, len(data) - n + 1))
        # only the first and the last byte may be an edge of the word
        at = at[before[at + n - 1] == before[at + 1]]
        buckets.append((_HASH.spans(sums, at, at + n) + np.uint64(n)) >> shift)
        places.append(at + 1)
    buckets.append(_HASH.spans(sums, starts, ends) >> shift)
    places.append(starts)
    word = np.searchsorted(starts, np.concatenate(places), "right") - 1
    return np.concatenate(buckets).astype(np.int64), word


def _kinds(texts: list[bytes]):
    """Distinct words, the kind of every word, and each text's first word."""
    hashes, samples, firsts = [], {}, [0]
    low = 0
    while low < len(texts):
        high, size = low, 0
        while high < len(texts) and (high == low or size + len(texts[high]) <= PASS_BYTES):
            size += len(texts[high])
            high += 1
        data, starts, ends, first = _tokens(texts[low:high])
        found = _HASH.spans(_HASH.sums(data), starts, ends)
        for h, at in zip(*(x.tolist() for x in np.unique(found, return_index=True))):
            if h not in samples:
                samples[h] = data[starts[at] : ends[at]].tobytes()
        hashes.append(found)
        firsts += [f + firsts[low] for f in first[1:].tolist()]
        low = high
    kinds, kind = np.unique(np.concatenate(hashes), return_inverse=True)
    return [samples[h] for h in kinds.tolist()], kind, np.array(firsts)


def _features_by_part(kinds: list[bytes]):
    """Features of a bounded number of words at a time: number of the first, buckets, words."""
    for low in range(0, len(kinds), PART_KINDS):
        data, starts, ends, _ = _tokens([b" ".join(kinds[low : low + PART_KINDS])])
        yield low, *_features(data, starts, ends)


def _windows(firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word of every window, and first window of every text; an empty text has none."""
    counts = -(-np.diff(firsts) // WINDOW_WORDS)
    first_window = np.concatenate([[0], np.cumsum(counts)])
    owner = np.repeat(np.arange(len(counts)), counts)
    within = np.arange(first_window[-1]) - first_window[owner]
    return firsts[owner] + within * WINDOW_WORDS, first_window


class Model:
    """One number per bucket and an offset; ``margin`` is the softmax's logit of a window."""

    def __init__(self, weights: np.ndarray, offset: float):
        self.weights, self.offset = weights, offset

    def scores(self, texts: list[bytes]) -> np.ndarray:
        data, word_starts, ends, firsts = _tokens(texts)
        words = len(word_starts)
        margins = np.full(len(texts), self.offset)
        if words:
            buckets, word = _features(data, word_starts, ends)
            totals = np.bincount(word, self.weights[buckets], words)
            value = totals / np.bincount(word, minlength=words)
            starts, first_window = _windows(firsts)
            sizes = np.diff(np.append(starts, firsts[-1]))
            window = np.add.reduceat(value, starts) / sizes + self.offset
            filled = np.flatnonzero(np.diff(first_window))
            cuts = first_window[filled]
            owner = np.repeat(np.arange(len(filled)), np.diff(first_window)[filled])
            worst = np.maximum.reduceat(window, cuts)
            pull = np.exp(SHARPNESS * (window - worst[owner]))
            margins[filled] = np.add.reduceat(pull * window, cuts) / np.add.reduceat(pull, cuts)
        return 1 / (1 + np.exp(-np.clip(margins, -60, 60)))


def train(texts: list[bytes], labels: np.ndarray, weights: np.ndarray) -> Model:
    """Full-batch Adam on embeddings and softmax together.

    With two classes the loss depends on the softmax's columns by their difference only. The
    gradient of a text goes to its windows by their softmax, so it finds the toxic window. Buckets
    that fewer than ``LEAST_TEXTS`` texts hold, counted word by word, stay out.
    """
    generator = np.random.Generator(np.random.PCG64(41))
    # equal words share their features: work on kinds of words
    kinds, kind, firsts = _kinds(texts)
    text_of_word = np.repeat(np.arange(len(texts)), np.diff(firsts))
    met = np.unique(text_of_word * len(kinds) + kind) % len(kinds)
    texts_of_kind = np.bincount(met, minlength=len(kinds))
    lengths, holders = np.zeros(len(kinds)), np.zeros(BUCKETS)
    for low, buckets, of_kind in _features_by_part(kinds):
        lengths[low : low + PART_KINDS] = np.bincount(of_kind)
        holders += np.bincount(buckets, texts_of_kind[low + of_kind], BUCKETS)
    used = np.flatnonzero(holders >= LEAST_TEXTS)
    number = np.full(BUCKETS, -1, np.int32)
    number[used] = np.arange(len(used), dtype=np.int32)
    parts = []
    for low, buckets, of_kind in _features_by_part(kinds):
        common = number[buckets] >= 0
        size = min(PART_KINDS, len(kinds) - low)
        parts.append((low, size, number[buckets[common]], of_kind[common].astype(np.uint16)))
    del holders, number, met, text_of_word
    starts, first_window = _windows(firsts)
    sizes = np.diff(np.append(starts, firsts[-1]))
    window_of_word = np.repeat(np.arange(len(starts)), sizes)
    filled = np.flatnonzero(np.diff(first_window))
    cuts_text = first_window[filled]
    text_of_window = np.repeat(np.arange(len(filled)), np.diff(first_window)[filled])
    truth, share = labels[filled].astype(float), weights[filled] / weights[filled].sum()
    table = generator.normal(0, 0.01, (len(used), DIMENSIONS))
    column, offset = generator.normal(0, 1, DIMENSIONS), np.zeros(1)
    state = [[np.zeros_like(x), np.zeros_like(x)] for x in (table, column, offset)]

    def update(x, m, v, g, step):
        m *= 0.9
        m += 0.1 * g
        v *= 0.99
        v += 0.01 * g * g
        x -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)

    for step in range(1, STEPS + 1):
        worth, value = table @ column, np.empty(len(kinds))
        for low, size, flat, of_kind in parts:
            value[low : low + size] = np.bincount(of_kind, worth[flat], size)
        value /= lengths
        margin = np.bincount(window_of_word, value[kind], len(starts)) / sizes + offset[0]
        worst = np.maximum.reduceat(margin, cuts_text)
        pull = np.exp(SHARPNESS * (margin - worst[text_of_window]))
        pull /= np.add.reduceat(pull, cuts_text)[text_of_window]
        pooled = np.add.reduceat(pull * margin, cuts_text)
        error = (1 / (1 + np.exp(-np.clip(pooled, -60, 60))) - truth) * share
        slope = error[text_of_window] * pull
        to_kind = np.bincount(kind, (slope / sizes)[window_of_word], len(kinds)) / lengths
        to_bucket = np.zeros(len(used))
        for low, size, flat, of_kind in parts:
            to_bucket += np.bincount(flat, to_kind[low : low + size][of_kind], len(used))
        of_column = table.T @ to_bucket + DECAY * column
        for low in range(0, len(used), PART_BUCKETS):
            rows = slice(low, low + PART_BUCKETS)
            gradient = np.outer(to_bucket[rows], column) + DECAY * table[rows]
            update(table[rows], state[0][0][rows], state[0][1][rows], gradient, step)
        update(column, *state[1], of_column, step)
        update(offset, *state[2], slope.sum(keepdims=True), step)
    numbers = np.zeros(BUCKETS)
    numbers[used] = table @ column
    return Model(numbers, float(offset[0]))


def fit(docs: DataFrame, labels: DataFrame, may_learn: Column | None = None) -> Model:
    """Train on at most ``SAMPLE_ROWS`` labelled texts of each kind, chosen by hash of the id.

    ``may_learn`` is a condition on ``doc_id`` that labelled rows must meet.
    """
    marked = (
        labels.where("toxic in (0, 1)")
        .groupBy(F.col("doc_id").alias("_doc"))
        .agg(F.max("toxic").cast("int").alias("label"))
    )
    known = docs.where("text is not null")
    known = known if may_learn is None else known.where(may_learn)
    known = known.select(F.col("doc_id").alias("_id"), F.xxhash64("doc_id", "text").alias("_h"))
    known = known.join(marked, F.col("_id") == F.col("_doc"))
    counts = dict(known.groupBy("label").count().collect())
    texts, truth, weights = [], [], []
    for label in (0, 1):
        # ids first, so that only the sample's texts reach the driver
        sample = known.where(F.col("label") == label).orderBy("_h", "_id").limit(SAMPLE_ROWS)
        keyed = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("_key"))
        rows = (
            keyed.join(
                F.broadcast(sample.select("_id", "_h").distinct()),  # at most SAMPLE_ROWS rows
                (F.col("doc_id") == F.col("_id")) & (F.col("_key") == F.col("_h")),
            )
            .dropDuplicates(["doc_id", "_key"])
            .select("_key", "text")
            .collect()
        )
        rows.sort()
        texts += [r.text.encode() for r in rows]
        truth += [label] * len(rows)
        weights += [counts.get(label, 0) / len(rows) if rows else 0.0] * len(rows)
    if len(set(truth)) < 2 or not any(texts):
        return Model(np.zeros(BUCKETS), 0.0)
    return train(texts, np.array(truth), np.sqrt(np.array(weights)))


def with_scores(docs: DataFrame, model: Model, columns: list[str]) -> DataFrame:
    """The named columns and ``_score``, the probability of label 1."""
    kept = [c for c in columns if c != "text"]
    weights, offset = docs.sparkSession.sparkContext.broadcast(model.weights), model.offset

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(weights.value, offset)
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            scores = [np.zeros(0)]
            for _, _, part, marks in passes(data, offsets):
                raw = part.tobytes()
                scores.append(
                    own.scores([raw[a:b] for a, b in zip(marks[:-1].tolist(), marks[1:].tolist())])
                )
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(np.concatenate(scores))],
                [*columns, "_score"],
            )

    schema = docs.select(*columns).schema.add("_score", "double")
    return docs.select(*kept, "text").mapInArrow(score, schema)


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier does not reject, with all columns."""
    # the row as one column, so that no name of the table can clash
    rows = docs.select("text", F.struct(*docs.columns).alias("row"))
    scored = with_scores(rows, fit(docs, labels), ["row"])
    return scored.where(F.col("_score") < THRESHOLD).select("row.*")

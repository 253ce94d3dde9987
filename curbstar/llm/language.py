"""Language of texts: sparse multinomial logistic regression on TF-IDF character n-grams.

Characters are lower-cased; all that are not letters count as one edge mark. N-grams of 1 to 3 are
hashed into buckets; document frequencies come from all documents that may be learnt from. The
regression is trained by follow-the-regularised-leader with elastic-net penalties on a bounded
sample, then a temperature is fitted by Newton steps on a part of the sample that training did not
see, against smoothed labels, so that it stays finite where every text is predicted right.

Defined results: a null text and one without a letter is ``und`` with score 0; so is every text when
nothing can be learnt; repeated rows agree; ties go to the language that sorts first. Very long texts
count whole, in sums of one number a bucket. Of a ``lang`` column with more than ``LANGUAGES`` values,
the most frequent (ties: those that sort first) are learnt.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbstar.llm.common import mix

BUCKET_BITS, NGRAMS = 15, 3
#: Languages that are learnt, and texts of each that training takes, by hash of id and text; one in five
#: tunes the temperature.
LANGUAGES, SAMPLE_ROWS = 200, 800
#: Parts in which each language's texts are ranked first, so that no task ranks a whole language.
PARTS = 64
EPOCHS, ALPHA, BETA, LASSO, RIDGE = 2, 0.5, 1.0, 0.003, 0.3
PASS_CHARS = 1 << 20
UNDETERMINED = "und"

_BUCKETS = 1 << BUCKET_BITS
_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    return _LETTERS[0]


def bucket_counts(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets and counts of each text's n-grams; a text without letters has none."""
    low = 0
    while low < len(texts):
        high, size = low, 0
        while high < len(texts) and (high == low or size + len(texts[high]) <= PASS_CHARS):
            size += len(texts[high])
            high += 1
        lowered = [t.lower() for t in texts[low:high]]
        codes = np.frombuffer(
            (" " + " ".join(lowered) + "  ").encode("utf-32-le", "surrogatepass"), np.uint32
        )
        codes = np.where(_letters()[codes], codes, 0).astype(np.uint64)
        marks = np.concatenate([[0], np.cumsum([len(t) + 1 for t in lowered])])
        count = len(codes) - 2
        one, two, three = codes[:-2], codes[1:-1], codes[2:]
        shift = np.uint64(64 - BUCKET_BITS)
        first = mix(two) >> shift
        pair = mix(one * np.uint64(0x100000001B3) + two + np.uint64(1 << 40)) >> shift
        triple = (
            mix((one * np.uint64(0x100000001B3) + two) * np.uint64(0x1000193) + three
                + np.uint64(1 << 41)) >> shift
        )
        grams = np.stack([first, pair, triple]).astype(np.int64)
        valid = np.stack([two > 0, (two > 0) | (one > 0), two > 0])
        for a, b in zip(marks[:-1].tolist(), marks[1:].tolist()):
            b = min(b, count)
            counts = np.bincount(grams[:, a:b][valid[:, a:b]], minlength=_BUCKETS)
            found = np.flatnonzero(counts)
            yield found, counts[found]
        low = high


class Model:
    def __init__(self, languages: list[str], idf: np.ndarray, weights: np.ndarray,
                 offsets: np.ndarray, temperature: float):
        self.languages, self.idf, self.weights = languages, idf, weights
        self.offsets, self.temperature = offsets, temperature
        #: Log loss of the texts that tuned the temperature, before and after.
        self.losses: tuple[float, float] | None = None

    def vector(self, buckets: np.ndarray, counts: np.ndarray) -> np.ndarray:
        values = (1 + np.log(counts)) * self.idf[buckets]
        return values / max(np.sqrt((values * values).sum()), 1e-12)

    def predict(self, buckets: np.ndarray, counts: np.ndarray) -> tuple[str, float]:
        if not len(buckets) or not self.languages:
            return UNDETERMINED, 0.0
        logits = self.vector(buckets, counts) @ self.weights[buckets] + self.offsets
        chances = _softmax(logits / self.temperature)
        best = int(chances.argmax())
        return self.languages[best], float(chances[best])


def _softmax(logits: np.ndarray) -> np.ndarray:
    raised = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return raised / raised.sum(axis=-1, keepdims=True)


def fitted_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss, against labels that lose ``1 / (rows + 2)`` to the others.

    The loss is convex in the inverse temperature; Newton steps that would leave its range are halved.
    """
    count, kinds = logits.shape
    if kinds < 2 or not np.ptp(logits, axis=1).any():
        return 1.0
    wanted = np.full(logits.shape, 1 / (count + 2) / (kinds - 1))
    wanted[np.arange(count), labels] = 1 - 1 / (count + 2)
    inverse = 1.0
    for _ in range(100):
        chances = _softmax(logits * inverse)
        mean = (chances * logits).sum(axis=1)
        slope = (mean - (wanted * logits).sum(axis=1)).mean()
        bend = ((chances * logits * logits).sum(axis=1) - mean * mean).mean()
        step = float(np.clip(slope / max(bend, 1e-12), -inverse, inverse / 2))
        inverse = float(np.clip(inverse - step, 1e-3, 1e3))
        if abs(step) < 1e-9 * inverse:
            break
    return 1 / inverse


def log_loss(logits: np.ndarray, labels: np.ndarray, temperature: float) -> float:
    chances = _softmax(logits / temperature)[np.arange(len(labels)), labels]
    return float(-np.log(chances + 1e-300).mean())


def train(found: list[tuple[np.ndarray, np.ndarray]], truth: list[str], idf: np.ndarray) -> Model:
    """FTRL-proximal on buckets and counts, one text at a time, in an order fixed by a seed."""
    languages = sorted(set(truth))
    model = Model(languages, idf, np.zeros((_BUCKETS, len(languages))), np.zeros(len(languages)), 1.0)
    rows = [(b, model.vector(b, c)) for b, c in found]
    labels = np.array([languages.index(t) for t in truth])
    learn = [k for k in range(len(rows)) if k % 5 and len(rows[k][0])]
    tune = [k for k in range(len(rows)) if k % 5 == 0 and len(rows[k][0])]
    z, n = np.zeros_like(model.weights), np.zeros_like(model.weights)
    z_offset, n_offset = np.zeros(len(languages)), np.zeros(len(languages))
    generator = np.random.Generator(np.random.PCG64(51))

    def solve(z: np.ndarray, n: np.ndarray, lasso: float) -> np.ndarray:
        slack = np.sign(z) * np.maximum(np.abs(z) - lasso, 0)
        return -slack / ((BETA + np.sqrt(n)) / ALPHA + RIDGE)

    for _ in range(EPOCHS):
        for k in generator.permutation(learn):
            buckets, values = rows[k]
            weights, offsets = solve(z[buckets], n[buckets], LASSO), solve(z_offset, n_offset, 0)
            error = _softmax(values @ weights + offsets)
            error[labels[k]] -= 1
            for z_, n_, w_, g, at in ((z, n, weights, values[:, None] * error, buckets),
                                      (z_offset, n_offset, offsets, error, slice(None))):
                sigma = (np.sqrt(n_[at] + g * g) - np.sqrt(n_[at])) / ALPHA
                z_[at] += g - sigma * w_
                n_[at] += g * g
    model.weights, model.offsets = solve(z, n, LASSO), solve(z_offset, n_offset, 0)
    if tune:
        logits = np.stack([rows[k][1] @ model.weights[rows[k][0]] + model.offsets for k in tune])
        model.temperature = fitted_temperature(logits, labels[tune])
        model.losses = (
            log_loss(logits, labels[tune], 1.0), log_loss(logits, labels[tune], model.temperature)
        )
    return model


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """Smoothed inverse document frequency of every bucket, over all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = 0, np.zeros(_BUCKETS, np.int64)
        for batch in batches:
            for buckets, _ in bucket_counts([t or "" for t in batch.column("text").to_pylist()]):
                seen[buckets] += 1
                total += 1
        found = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(found, -1)), pa.array(np.append(seen[found], total))],
            ["bucket", "texts"],
        )

    sums = docs.select("text").mapInArrow(count, "bucket long, texts long")
    found = dict(sums.groupBy("bucket").agg(F.sum("texts")).collect())  # a row per bucket
    total = found.pop(-1, 0)
    texts = np.zeros(_BUCKETS)
    texts[list(found)] = list(found.values())
    return np.log((1 + total) / (1 + texts)) + 1


def fit(docs: DataFrame, may_learn: Column | None = None) -> Model:
    """Train on at most ``SAMPLE_ROWS`` rows of each of at most ``LANGUAGES`` languages, repeated ones once.

    ``may_learn`` is a condition on ``doc_id`` that rows must meet. Rows are chosen by hashes alone;
    what reaches the driver of a chosen text is its buckets and counts.
    """
    known = docs.select("doc_id", "text", "lang").where("text is not null and lang is not null")
    known = known if may_learn is None else known.where(may_learn)
    languages = [
        r.lang for r in known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()
    ]
    # ranked in parts by language, then at most PARTS * SAMPLE_ROWS narrow rows of each language
    hashed = known.where(F.col("lang").isin(languages)).select(
        "lang", F.xxhash64("doc_id", "text").alias("key")
    )
    hashed = hashed.withColumn("part", F.pmod("key", F.lit(PARTS)))
    in_part = Window.partitionBy("lang", "part").orderBy("key")
    in_language = Window.partitionBy("lang").orderBy("key")
    chosen = (
        hashed.withColumn("place", F.row_number().over(in_part))
        .where(F.col("place") <= SAMPLE_ROWS)
        .withColumn("place", F.row_number().over(in_language))
        .where(F.col("place") <= SAMPLE_ROWS)
        .select(F.col("lang").alias("of"), "key").distinct()
    )

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(bucket_counts(batch.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("lang"),
                 pa.array([b for b, _ in found], pa.list_(pa.int64())),
                 pa.array([c for _, c in found], pa.list_(pa.int64()))],
                ["key", "lang", "buckets", "counts"],
            )

    keyed = known.select("text", "lang", F.xxhash64("doc_id", "text").alias("own"))
    rows = (
        # at most LANGUAGES * SAMPLE_ROWS keys
        keyed.join(F.broadcast(chosen), (F.col("own") == F.col("key")) & (F.col("lang") == F.col("of")))
        .select("key", "lang", "text")
        .mapInArrow(features, "key long, lang string, buckets array<long>, counts array<long>")
        .dropDuplicates(["key", "lang"])
        .collect()
    )
    rows.sort(key=lambda r: (r.key, r.lang))
    found = [(np.array(r.buckets, np.int64), np.array(r.counts, np.int64)) for r in rows]
    return train(found, [r.lang for r in rows], inverse_frequencies(known))


def identify(docs: DataFrame, model: Model, columns: list[str]) -> DataFrame:
    """The named columns, ``lang_pred`` and ``score``, from nothing but the text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            found = [shared.value.predict(b, c) for b, c in bucket_counts(texts)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns),
                 pa.array([f[0] for f in found], pa.string()),
                 pa.array([f[1] for f in found], pa.float64())],
                [*columns, "lang_pred", "score"],
            )

    schema = docs.select(*columns).schema.add("lang_pred", "string").add("score", "double")
    return docs.select(*[c for c in columns if c != "text"], "text").mapInArrow(predict, schema)

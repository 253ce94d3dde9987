"""Document fingerprints of improbable features, and their likeness.

Every byte window of a text gets the entropy of its bytes, and every entropy a rank: the rarer it is
among all windows of all texts, the lower. In each run of neighbouring windows the lowest rank (the
leftmost of equals) scores a point; windows with enough points are the text's features. Features go
into Bloom filters, a new one in the chain whenever the last is full. Two chains are compared filter
by filter: bits set in both, above what chance would give, as a share of what is possible.

Defined results: a null text is empty and its fingerprint is the empty string; a text shorter than a
window is one feature; equal texts have equal fingerprints and likeness 1, an empty text has
likeness 0 with any other; rows with equal ids follow each other in the order of their texts, null
ids last; a single document is its own next one; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbstar.llm.common import RollingHash, mix, passes, sliding_argmin, utf8

#: Bytes of a window, neighbouring windows that compete, and points that make a feature.
WINDOW, NEIGHBOURS, POINTS = 32, 32, 8
LEVELS = 256
#: Bits of a filter, bits set per feature, features of a full filter, share of bits left to chance.
FILTER_BITS, BITS_SET, FILTER_FEATURES, CHANCE = 2048, 5, 160, 0.3
#: Documents between two bounds of the id, and the most bounds that are worth their comparisons.
RANGE_ROWS, MOST_RANGES = 20_000, 4096

_HASH = RollingHash(71)
_COUNTS = np.arange(WINDOW + 1)
_PLOGP = np.round(
    np.where(_COUNTS > 0, _COUNTS * np.log2(np.maximum(_COUNTS, 1)), 0) * (1 << 20)
).astype(np.int64)
_MOST = int(_PLOGP[WINDOW])
_BLOCK = 1 << 15


def entropy_levels(data: np.ndarray) -> np.ndarray:
    """Quantised entropy of every window.

    Moving a window by one byte changes the sum of ``c * log(c)`` by what the leaving and the
    entering byte contribute, which depends on how often they occur in the window around them.
    """
    size = len(data)
    if size < WINDOW:
        return np.zeros(0, np.uint8)
    after, before = np.zeros(size, np.uint8), np.zeros(size, np.uint8)
    for low in range(0, size, _BLOCK):
        part = data[low : low + _BLOCK + WINDOW]
        for gap in range(1, min(WINDOW, len(part))):
            here = part[: min(_BLOCK, len(part) - gap)]
            equal = (here == part[gap : gap + len(here)]).view(np.uint8)
            after[low : low + len(here)] += equal
            before[low + gap : low + gap + len(here)] += equal
    leaves = _PLOGP[after[: size - WINDOW] + 1] - _PLOGP[after[: size - WINDOW]]
    enters = _PLOGP[before[WINDOW:] + 1] - _PLOGP[before[WINDOW:]]
    total = np.empty(size - WINDOW + 1, np.int64)
    total[0] = _PLOGP[np.bincount(data[:WINDOW])].sum()
    total[1:] = total[0] + np.cumsum(enters - leaves)
    return ((_MOST - total) * (LEVELS - 1) // _MOST).astype(np.uint8)


def rarity(docs: DataFrame) -> np.ndarray:
    """How often each entropy level occurs, over all windows of all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(LEVELS, np.int64)
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for _, _, part, marks in passes(data, offsets):
                levels = entropy_levels(part)
                inside = np.ones(len(levels), bool)
                for mark in marks[1:-1].tolist():
                    inside[max(0, mark - WINDOW + 1) : mark] = False
                seen += np.bincount(levels[inside], minlength=LEVELS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(LEVELS)), pa.array(seen)], ["level", "windows"]
        )

    sums = docs.select("text").mapInArrow(count, "level long, windows long")
    found = dict(sums.groupBy("level").agg(F.sum("windows")).collect())  # a row per level
    return np.array([found.get(k, 0) for k in range(LEVELS)])


def features(data: np.ndarray, offsets: np.ndarray, ranks: np.ndarray) -> Iterator[np.ndarray]:
    """Hashes of each text's features, in the order of the text."""
    levels = entropy_levels(data)
    sums = _HASH.sums(data)
    # the rank decides in the upper bits; positions break ties, so the leftmost of equals wins
    keys = ranks[levels].astype(np.uint64) << np.uint64(54)
    winners = sliding_argmin(keys, NEIGHBOURS) if len(keys) else np.zeros(0, np.int64)
    begins = np.arange(len(winners))
    text = np.searchsorted(offsets, begins, "right") - 1
    inside = begins + NEIGHBOURS + WINDOW - 1 <= offsets[text + 1]
    points = np.bincount(winners[inside], minlength=len(levels))
    for low, high in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        windows = high - low - WINDOW + 1
        if high == low:
            at = np.zeros(0, np.int64)
        elif windows <= NEIGHBOURS:
            # fewer windows than compete: the best alone, or the whole text
            best = low + int(keys[low : low + windows].argmin()) if windows > 0 else low
            at = np.array([best])
        else:
            own = points[low : low + windows]
            at = np.flatnonzero(own >= POINTS) + low
            if not len(at):
                at = np.array([low + int(own.argmax())])
        yield _HASH.spans(sums, at, np.minimum(at + WINDOW, high))


class Digest:
    """A chain of Bloom filters with the features in each."""

    def __init__(self, found: np.ndarray):
        _, first = np.unique(found, return_index=True)
        found = mix(found[np.sort(first)])
        self.counts, filters = [], []
        for low in range(0, len(found), FILTER_FEATURES):
            part = found[low : low + FILTER_FEATURES]
            bits = np.zeros(FILTER_BITS, np.uint8)
            for k in range(BITS_SET):
                bits[(part >> np.uint64(11 * k)) % np.uint64(FILTER_BITS)] = 1
            filters.append(np.packbits(bits))
            self.counts.append(len(part))
        self.filters = np.stack(filters).view(np.uint64) if filters else None
        self.text = ";".join(
            f"{n}:{base64.b64encode(f.tobytes()).decode()}" for n, f in zip(self.counts, filters)
        )

    def likeness(self, other: Digest) -> float:
        if self.text == other.text:
            return 1.0
        if self.filters is None or other.filters is None:
            return 0.0
        few, many = sorted((self, other), key=lambda d: len(d.filters))
        ones = np.bitwise_count(few.filters).sum(axis=1).astype(float)
        others = np.bitwise_count(many.filters).sum(axis=1).astype(float)
        best = []
        for row, own in zip(few.filters, ones):
            shared = np.bitwise_count(many.filters & row).sum(axis=1).astype(float)
            least, most = own * others / FILTER_BITS, np.minimum(own, others)
            floor = least + CHANCE * 0.1 * (most - least)
            best.append(np.clip((shared - floor) / np.maximum(most - floor, 1e-9), 0, 1).max())
        return float(np.mean(best))


def with_next(docs: DataFrame) -> DataFrame:
    """Rows ``doc_id, text, part, place`` dealt to ranges of falling id, each range ending with a
    copy (``place`` 1) of the row that follows its last.

    Bounds come from the ids alone; texts move once.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    count = rows.count()
    parts = min(max(1, -(-count // RANGE_ROWS)), MOST_RANGES)
    cuts = [k / parts for k in range(1, parts)]
    bounds = rows.approxQuantile("doc_id", cuts, 0.1 / parts) if cuts else []
    bounds = sorted({int(b) for b in bounds}, reverse=True)
    # part 0 holds the largest ids; null ids come last
    every = F.lit(bounds) if bounds else F.array().cast("array<long>")
    part = F.size(F.filter(every, lambda b: F.col("doc_id") <= b))
    part = F.when(F.col("doc_id").isNull(), F.lit(len(bounds) + 1)).otherwise(part)
    dealt = rows.withColumn("part", part.cast("int"))
    firsts = (
        dealt.select("part", "doc_id", F.xxhash64("text").alias("h"), F.coalesce("text", F.lit("")).alias("t"))
        .groupBy("part")
        .agg(F.max("doc_id").alias("doc_id"))
        .collect()  # a row per range
    )
    order = sorted((r.part, r.doc_id) for r in firsts)
    schema = "before int, first_part int, first_id long"
    follows = [
        (order[k - 1][0], part, doc_id) for k, (part, doc_id) in enumerate(order)
    ]
    links = docs.sparkSession.createDataFrame(follows or [(0, 0, None)], schema)
    heads = (
        dealt.join(
            F.broadcast(links),  # a row per range
            (F.col("part") == F.col("first_part")) & F.col("doc_id").eqNullSafe(F.col("first_id")),
        )
        .groupBy("before", "doc_id")
        .agg(F.min(F.struct(F.coalesce("text", F.lit("")))).alias("s"))
        .select("doc_id", F.col("s.col1").alias("text"), F.col("before").alias("part"),
                F.lit(1).alias("place"))
    )
    return dealt.withColumn("place", F.lit(0)).unionByName(heads)


def _compare(ranks: np.ndarray):
    def digests_of(texts: list[str]) -> list[Digest]:
        array = pa.array(texts, pa.string())
        data, offsets = utf8(array)
        return [
            Digest(found)
            for _, _, part, marks in passes(data, offsets)
            for found in features(part, marks, ranks)
        ]

    def settle(rows: list[tuple]) -> pa.RecordBatch:
        """All but the last row of a stretch, each with its successor; stretches overlap by one."""
        texts = [r[1] or "" for r in rows]
        own = digests_of(texts)
        pairs = [k for k in range(len(rows) - 1) if rows[k][2] == rows[k + 1][2] and not rows[k][3]]
        edited = []
        for k in pairs:
            half = len(texts[k]) // 2
            edited.append(texts[k][: len(texts[k]) - half] + texts[k + 1][:half])
        theirs = digests_of(edited)
        columns = zip(*(
            (rows[k][0], len(texts[k]), hashlib.sha256(e.encode()).hexdigest(), own[k].text, d.text,
             own[k].likeness(d), own[k].likeness(own[k + 1]))
            for k, e, d in zip(pairs, edited, theirs)
        ))
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(),
                 pa.float64())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(list(columns) or [()] * len(kinds), kinds)], _RESULT
        )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                held.append(row)
                size += len(row[1] or "")
                if size >= 1 << 20 and len(held) > 1:
                    yield settle(held)
                    held, size = held[-1:], len(held[-1][1] or "")
        if len(held) > 1:
            yield settle(held)

    return compare


_RESULT = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited",
           "near_next"]


def compare_with_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edit, and how alike they are: see ``op3``."""
    windows = rarity(docs)
    ranks = np.argsort(np.argsort(windows, kind="stable"), kind="stable")
    dealt = with_next(docs)
    return (
        dealt.repartition("part")
        .sortWithinPartitions(
            F.col("part"), F.col("place"), F.col("doc_id").desc_nulls_last(),
            F.coalesce("text", F.lit("")),
        )
        .select("doc_id", "text", "part", "place")
        .mapInArrow(
            _compare(ranks),
            "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
            "edited_fingerprint string, near_edited double, near_next double",
        )
    )

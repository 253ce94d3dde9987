"""Phrases whose words occur together more often than their parts suggest, by prefix-free parsing.

Texts are cut into chunks wherever a window of ``longest - 1`` words has a hash divisible by
``period``, so that equal passages give equal chunks whatever surrounds them. A chunk runs through
the window at its end, which also begins the next chunk; the phrases that start in this overlap
belong to the next chunk alone. Distinct chunks and how often each occurs form the dictionary, and
phrases are counted in the dictionary, each weighed by its chunk's frequency.

Counting goes by length. Sums by 64-bit hash never fall short of a phrase's own count, so they show
which phrases can reach ``least``; a longer phrase is only looked at where its parts can. What is
left is then counted by its words. Which hashes are frequent reaches the tasks in a bit filter of
fixed size: a full filter lets more phrases through to the exact count and changes no result.

Defined results: a null text is empty; a null language is ``und``; repeated rows count again; texts
without words and empty tables give no phrases; equal scores are ordered by count, then by the
phrase's bytes. Long texts are chunks like any others. Columns other than ``text`` and ``lang`` are
not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from curbstar.llm.common import RollingHash, Scratch, lower_ascii, mix, passes, utf8

LONGEST, LEAST, KEEP = 4, 30, 2000
#: Scores are counts per SCALE; a longer phrase swallows a part from SWALLOW percent of it on.
SCALE, SWALLOW = 2_000_000, 80
#: Words between two triggers, on average.
PERIOD = 32
#: Bits of the filter of frequent hashes, and bits set for each.
FILTER_BITS, BITS_SET = 1 << 26, 4
#: Bytes of the dictionary in one numpy pass, and hashes that a task sums before it hands them on.
PASS_BYTES, HELD = 1 << 22, 1 << 21

_WORD, _SECOND = RollingHash(131), RollingHash(137)
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 2


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return _WORD.spans(_WORD.sums(data), starts, ends) + (ends - starts).astype(np.uint64)


def _lengthen(keys: np.ndarray, words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of ``n`` words each, from those of ``n - 1``."""
    count = max(0, len(words) - n + 1)
    return mix(keys[:count] ^ mix(words[n - 1 : n - 1 + count] + np.uint64(n)))


def _slices(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, last: int | None = None
) -> pa.Array:
    """``data[start:end]`` for every pair, as one binary array; ``last`` replaces each last byte."""
    sizes = ends - starts
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(sizes, out=offsets[1:])
    taken = data[np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])]
    if last is not None:
        taken[offsets[1:] - 1] = last
    return pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(taken)]
    ).cast(pa.binary())


def _cut(data: np.ndarray, marks: np.ndarray, overlap: int, period: int):
    """A pass's texts, each ended by a line feed, as chunks: bytes, text of each, words owned.

    In a chunk one blank follows each word, or a line feed where the piece or the chunk ends.
    """
    data = lower_ascii(data)
    kind = _KIND[data]
    inside = kind == 0
    starts = np.flatnonzero(inside & ~np.r_[False, inside[:-1]])
    ends = np.flatnonzero(~inside & np.r_[False, inside[:-1]])
    if not len(starts):
        return pa.array([], pa.binary()), np.zeros(0, np.int64), np.zeros(0, np.int64)
    words = _word_hashes(data, starts, ends)
    text = np.searchsorted(marks, starts, "right") - 1
    piece = np.cumsum(kind == 2)[starts]
    ends_piece = np.r_[piece[1:] != piece[:-1], True]
    kept = inside.copy()
    kept[ends] = True
    clean = data.copy()
    clean[ends] = np.where(ends_piece, 10, 32)
    clean = clean[kept]
    clean_ends = np.cumsum(ends - starts + 1)
    clean_starts = np.r_[0, clean_ends[:-1]]

    window = mix(words)
    for n in range(2, overlap + 1):
        window = _lengthen(window, words, n)
    begins = np.r_[True, text[1:] != text[:-1]]
    count = len(window)
    begins[:count] |= (window % np.uint64(period) == 0) & (text[:count] == text[overlap - 1 :])
    first = np.flatnonzero(begins)
    after = np.r_[first[1:], len(words)]
    follows = np.r_[text[first[1:]] == text[first[:-1]], False]
    last = np.where(follows, after + overlap, after) - 1
    chunks = _slices(clean, clean_starts[first], clean_ends[last], 10)
    return chunks, text[first], after - first


def dictionary(docs: DataFrame, longest: int = LONGEST, period: int = PERIOD) -> DataFrame:
    """Distinct chunks: ``lang, chunk, owned, freq``; ``owned`` words at the front are its own."""
    overlap = max(1, longest - 1)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for low, _, part, marks in passes(data, offsets):
                chunks, text, owned = _cut(part, marks, overlap, period)
                langs = batch.column("lang").take(pa.array(text + low))
                yield pa.RecordBatch.from_arrays(
                    [langs, chunks, pa.array(owned)], ["lang", "chunk", "owned"]
                )

    texts = docs.select(
        F.coalesce("lang", F.lit("und")).alias("lang"),
        F.concat(F.coalesce("text", F.lit("")), F.lit("\n")).alias("text"),
    )
    chunks = texts.mapInArrow(cut, "lang string, chunk binary, owned long")
    return chunks.groupBy("lang", "chunk", "owned").agg(F.count("*").alias("freq"))


class KeyFilter:
    """Bits of frequent hashes: says yes to each of them, and to few others until it fills up."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @classmethod
    def of(cls, keys: DataFrame, size: int = FILTER_BITS) -> KeyFilter:
        """The filter of a column ``key``; what is collected never exceeds the filter's size."""
        step = F.shiftrightunsigned("key", 32).bitwiseAND(size - 1).bitwiseOR(F.lit(1))
        first = F.col("key").bitwiseAND(size - 1)
        places = [(first + step * i).bitwiseAND(size - 1) for i in range(BITS_SET)]
        blocks = (
            keys.select(F.explode(F.array(*places)).alias("at"))
            .groupBy(F.shiftright("at", 15).alias("block"))
            .agg(F.bitmap_construct_agg(F.col("at").bitwiseAND(32767)).alias("bits"))
        )
        bits = np.zeros(max(size // 8, 4096), np.uint8)
        for block, part in blocks.collect():
            bits[block * 4096 : (block + 1) * 4096] = np.frombuffer(part, np.uint8)
        return cls(bits)

    def has(self, keys: np.ndarray) -> np.ndarray:
        mask = np.uint64(len(self.bits) * 8 - 1)
        step = (keys >> np.uint64(32)) & mask | np.uint64(1)
        found = np.ones(len(keys), bool)
        for i in range(BITS_SET):
            at = (keys + step * np.uint64(i)) & mask
            found &= (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return found


class _Words:
    """The words of a pass over the dictionary, and their hashes."""

    def __init__(self, data: np.ndarray, marks: np.ndarray, owned: np.ndarray, salts: np.ndarray):
        self.data = data
        self.ends = np.flatnonzero((data == 32) | (data == 10))
        self.starts = np.r_[0, self.ends[:-1] + 1] if len(self.ends) else self.ends
        self.row = np.searchsorted(marks, self.starts, "right") - 1
        first = np.searchsorted(self.row, np.arange(len(owned)))
        place = np.arange(len(self.starts)) - first[self.row]
        self.own = place < owned[self.row]
        self.goes_on = data[self.ends] == 32
        self.words = _word_hashes(data, self.starts, self.ends)
        self.single = mix(self.words ^ salts[self.row])

    def levels(self, longest: int, frequent: list[KeyFilter]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Length, positions and hashes of the phrases that can still be frequent.

        Filters are those of single words, of pairs, and of all longer phrases; a phrase passes
        where all parts of the next smaller of these kinds do.
        """
        keys, can = self.single, None
        for n in range(1, longest + 1):
            if n > 1:
                keys = _lengthen(keys, self.words, n)
                if n == 2:
                    alone = frequent[0].has(self.single)
                    can = self.goes_on[:-1] & alone[:-1] & alone[1:]
                elif n == 3:
                    pair = self.goes_on[:-1] & frequent[1].has(pairs)
                    can = pair[:-1] & pair[1:]
                else:
                    can = can[:-1] & pair[n - 2 :]
                if n == 2:
                    pairs = keys
            at = np.flatnonzero(self.own[: len(keys)] if can is None else self.own[: len(keys)] & can)
            yield n, at, keys[at]
            if n == min(len(frequent) + 1, 3) and n < 3:
                return


def _salt(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def _each_pass(batch: pa.RecordBatch) -> Iterator[tuple[int, _Words, np.ndarray]]:
    """First row, words, and frequency of each row, pass by pass."""
    data, offsets = utf8(batch.column("chunk"))
    owned, freq = batch.column("owned").to_numpy(), batch.column("freq").to_numpy()
    kinds = batch.column("lang").dictionary_encode()
    salts = np.array([_salt(x) for x in kinds.dictionary.to_pylist()], np.uint64)
    salts = salts[kinds.indices.to_numpy()]
    for low, high, part, marks in passes(data, offsets, PASS_BYTES):
        yield low, _Words(part, marks, owned[low:high], salts[low:high]), freq[low:high]


def _added(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(weights[order], first)


def _sums(chunks: DataFrame, longest: int, frequent: list[KeyFilter], least: int) -> DataFrame:
    """Hashes whose phrases can occur ``least`` times: of words, of pairs, or of all longer ones."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def settled() -> tuple[np.ndarray, np.ndarray]:
            return _added(*(np.concatenate(x) for x in zip(*held)))

        def batch_of(keys: np.ndarray, weights: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), pa.array(weights)], ["key", "n"]
            )

        for batch in batches:
            for _, words, freq in _each_pass(batch):
                for n, at, keys in words.levels(longest, frequent):
                    if len(at) and n > len(frequent):
                        held.append(_added(keys, freq[words.row[at]]))
                        size += len(held[-1][0])
                if size > HELD:
                    keys, weights = settled()
                    if len(keys) > HELD // 2:
                        yield batch_of(keys, weights)
                        held, size = [], 0
                    else:
                        held, size = [(keys, weights)], len(keys)
        if held:
            yield batch_of(*settled())

    sums = chunks.mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    return sums.where(F.col("n") >= least).select("key")


def _exact(chunks: DataFrame, longest: int, frequent: list[KeyFilter], least: int) -> DataFrame:
    """``lang, phrase, words, f`` of every phrase that occurs ``least`` times, counted by its words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, words, freq in _each_pass(batch):
                seconds = _SECOND.sums(words.data)
                for n, at, keys in words.levels(longest, frequent):
                    passed = frequent[min(n, len(frequent)) - 1].has(keys)
                    at, keys = at[passed], keys[passed]
                    if not len(at):
                        continue
                    starts, ends = words.starts[at], words.ends[at + n - 1]
                    second = _SECOND.spans(seconds, starts, ends)
                    _, sample, member = np.unique(keys, return_index=True, return_inverse=True)
                    # phrases that share a hash but not their bytes stand for themselves
                    other = np.flatnonzero(second != second[sample[member]])
                    weights = freq[words.row[at]]
                    sums = np.zeros(len(sample), np.int64)
                    alike = np.ones(len(at), bool)
                    alike[other] = False
                    np.add.at(sums, member[alike], weights[alike])
                    shown = np.r_[sample, other]
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("lang").take(pa.array(words.row[at[shown]] + low)),
                            _slices(words.data, starts[shown], ends[shown]),
                            pa.array(np.full(len(shown), n, np.int32)),
                            pa.array(np.r_[sums, weights[other]]),
                        ],
                        ["lang", "phrase", "words", "f"],
                    )

    counted = chunks.mapInArrow(count, "lang string, phrase binary, words int, f long")
    return (
        counted.groupBy("lang", "phrase", "words")
        .agg(F.sum("f").alias("f"))
        .where(F.col("f") >= least)
        .select("lang", F.col("phrase").cast("string").alias("phrase"), "words", "f")
    )


def frequent_phrases(
    docs: DataFrame, scratch: Scratch, longest: int = LONGEST, least: int = LEAST,
    period: int = PERIOD, filter_bits: int = FILTER_BITS,
) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, words, f`` of phrases of 1 to ``longest`` words, and ``lang, n``: all words."""
    chunks = scratch.write("dictionary", dictionary(docs, longest, period))
    frequent: list[KeyFilter] = []
    for _ in range(min(longest, 3)):
        frequent.append(KeyFilter.of(_sums(chunks, longest, frequent, least), filter_bits))
    found = scratch.write("phrases", _exact(chunks, longest, frequent, least))
    totals = chunks.groupBy("lang").agg(F.sum(F.col("owned") * F.col("freq")).alias("n"))
    totals = scratch.write("totals", totals)
    scratch.drop("dictionary")
    return found, totals


def _part(phrase: str, first: Column, size: Column) -> Column:
    """``size`` words from word ``first`` (counted from 0) on."""
    return F.array_join(F.slice(F.split(phrase, " "), first + 1, size), " ")


def scored(found: DataFrame) -> DataFrame:
    """Phrases of two or more words with the cut that scores lowest: ``a, l, r, score``."""
    phrases = found.where("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"))
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.select(
        "*",
        _part("phrase", F.lit(0), F.col("k")).alias("front"),
        _part("phrase", F.col("k"), F.col("words") - F.col("k")).alias("rest"),
    )
    of_front = found.select("lang", F.col("phrase").alias("front"), F.col("f").alias("l"))
    of_rest = found.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    # the product may pass 64 bits; div on decimals is exact
    score = F.expr(f"cast(a as decimal(20, 0)) * {SCALE} div cast(l + r as decimal(20, 0))")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    return (
        cuts.join(of_front, ["lang", "front"])
        .join(of_rest, ["lang", "rest"])
        .groupBy("lang", "phrase", "words", "a")
        .agg(lowest)
        .select("lang", "phrase", "words", "a", "cut.l", "cut.r", "cut.score")
    )


def unswallowed(phrases: DataFrame, swallow: int = SWALLOW) -> DataFrame:
    """Phrases but those that a longer one holds in ``swallow`` percent of their occurrences."""
    longer = phrases.where("words > 2").select("lang", "phrase", "words", F.col("a").alias("of"))
    inner = longer.withColumn("size", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
    inner = inner.withColumn(
        "first", F.explode(F.sequence(F.lit(0), F.col("words") - F.col("size")))
    )
    most = (
        inner.select("lang", _part("phrase", F.col("first"), F.col("size")).alias("phrase"), "of")
        .groupBy("lang", "phrase")
        .agg(F.max("of").alias("most"))
    )
    kept = F.col("most").isNull() | (F.col("most") * 100 < F.col("a") * swallow)
    return phrases.join(most, ["lang", "phrase"], "left").where(kept).drop("most")


def collocations(
    docs: DataFrame, longest: int = LONGEST, least: int = LEAST, keep: int = KEEP,
    period: int = PERIOD, filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """The first ``keep`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``."""
    scratch = Scratch(docs.sparkSession)
    found, totals = frequent_phrases(docs, scratch, longest, least, period, filter_bits)
    phrases = unswallowed(scratch.write("scored", scored(found)))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = phrases.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)
    # a row per language
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )

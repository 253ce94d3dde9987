"""Shared pieces: scratch tables, whole texts as byte arrays, rolling hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbstar.session import new_scratch

#: Bytes of text that one numpy pass works on; a longer text is a pass of its own.
PASS_BYTES = 1 << 19


class Scratch:
    """Written tables that cut lineage, in a new folder of the shared scratch space that goes with
    the session."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = new_scratch(spark, "llm")

    def write(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("error").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Delete a table that nothing reads any more."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        path.getFileSystem(conf).delete(path, True)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def crc_of(doc_id: str = "doc_id"):
    """crc32 of the id as text, which splits rows into folds; null counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))


def count_words(text: str = "text"):
    """Number of runs of bytes other than ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast(
        "long"
    )


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one byte array, and where each begins (and the last ends); null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    filled = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(filled.buffers()[1], np.int64)[
        filled.offset : filled.offset + len(filled) + 1
    ]
    if len(filled) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = filled.buffers()[2]
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), offsets


def passes(
    data: np.ndarray, offsets: np.ndarray, limit: int = PASS_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a batch into runs of rows of bounded size: first row, end row, bytes, offsets."""
    low, rows = 0, len(offsets) - 1
    while low < rows:
        high = int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1
        high = min(max(high, low + 1), rows)
        yield low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


def random_words(seed: int, count: int, odd: bool = False) -> np.ndarray:
    """Fixed 64-bit numbers from a seed."""
    words = np.random.Generator(np.random.PCG64(seed)).integers(
        0, 2**64, count, dtype=np.uint64, endpoint=False
    )
    return words | np.uint64(1) if odd else words


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers, one to one."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


class RollingHash:
    """Polynomial hashes mod 2**64 of any substring, from one running sum.

    Each byte value stands for a random number, and a substring's hash does not depend on where it
    begins.
    """

    def __init__(self, seed: int):
        self.values = random_words(seed, 256)
        self.base = int(random_words(seed + 1, 1, odd=True)[0]) & ~2 | 5
        self.inverse = pow(self.base, -1, 2**64)
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _grow(self, size: int) -> None:
        if len(self.powers) <= size:
            ones = np.ones(max(size + 1, PASS_BYTES + 1), np.uint64)
            self.powers, self.inverses = ones.copy(), ones
            self.powers[1:] = np.uint64(self.base)
            self.inverses[1:] = np.uint64(self.inverse)
            np.multiply.accumulate(self.powers, out=self.powers)
            np.multiply.accumulate(self.inverses, out=self.inverses)

    def sums(self, data: np.ndarray) -> np.ndarray:
        self._grow(len(data))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.powers[: len(data)], out=sums[1:])
        return sums

    def spans(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((sums[ends] - sums[starts]) * self.inverses[starts])

    def windows(self, sums: np.ndarray, width: int) -> np.ndarray:
        """The hash of every substring of ``width`` bytes."""
        count = max(0, len(sums) - width)
        return mix((sums[width:] - sums[:count]) * self.inverses[:count])


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_WORD_HASH = RollingHash(11)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and each text's first word (and the end of the last)."""
    if len(data) == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def shingle_hashes(
    data: np.ndarray, offsets: np.ndarray, words: int
) -> Iterator[np.ndarray]:
    """Each text's distinct word shingles as sorted 64-bit hashes; A-Z count as a-z.

    A text with fewer words gives its whole sequence as one shingle; one without words, nothing.
    """
    data = lower_ascii(data)
    starts, ends, firsts = word_bounds(data, offsets)
    sums = _WORD_HASH.sums(data)
    word = _WORD_HASH.spans(sums, starts, ends) + (ends - starts).astype(np.uint64)
    count = max(0, len(word) - words + 1)
    shingles = np.full(count, words, np.uint64)
    for k in range(words):
        shingles = mix(shingles ^ word[k : k + count]) + np.uint64(k)
    for low, high in zip(firsts[:-1].tolist(), firsts[1:].tolist()):
        if high - low >= words:
            yield np.unique(shingles[low : high - words + 1])
        elif high > low:
            one = np.full(1, high - low, np.uint64)
            for k in range(low, high):
                one = mix(one ^ word[k : k + 1]) + np.uint64(k - low)
            yield one
        else:
            yield np.zeros(0, np.uint64)


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the smallest value (the leftmost of equals) in every window of ``width``.

    Values count by their upper 40 bits; running minima over blocks of ``width`` from both sides
    give every window's minimum.
    """
    count = len(values) - width + 1
    if count <= 0:
        return np.zeros(0, np.int64)
    low_bits = np.uint64(max(24, int(len(values)).bit_length()))
    keys = (values >> low_bits << low_bits) | np.arange(len(values), dtype=np.uint64)
    pad = -len(keys) % width
    blocks = np.concatenate([keys, np.full(pad, 2**64 - 1, np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])
    return (least & ((np.uint64(1) << low_bits) - np.uint64(1))).astype(np.int64)

"""Long repeated byte strings: a run-length index of the places that can match.

A string of ``least`` bytes counts as repeated where it starts at two places, in one text or two.

* Every window of ``least`` bytes has an anchor: the short substring of it whose hash is smallest,
  the leftmost of equals. Equal windows have equal anchors at equal places, so windows meet by the
  anchor's hash. Neighbouring windows with one anchor form one context, the unit of all shuffles.
* Contexts that occur twice are repeated as a whole, and only counted.
* Contexts that occur once, but share their anchor with others, are indexed with one copy of each of
  those: sorted suffixes, the Burrows-Wheeler transform kept as runs, and the suffixes at both ends
  of every run as samples. The match length with the neighbour in suffix order is compared only at
  these samples; everywhere between, the matching statistic of the next byte is one less. Streaming
  both directions over the text gives each byte's longest match with any other suffix.
* Anchors with very many contexts, such as a line that a third of all texts hold, would make an
  index without bound. Their contexts are split by anchors almost as wide as a window, counted as
  above, and the windows of what still differs are counted by digest, which is just as exact.

Defined results: a null text is empty; texts shorter than ``least`` have nothing to match; matches
never cross texts; repeated rows repeat each other in full; rows that share an id are told apart by
their text; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbstar.llm.common import PASS_BYTES, RollingHash, Scratch, sliding_argmin, utf8

#: Bytes of contexts that one index covers, and contexts of one anchor that go into an index.
INDEX_BYTES, GROUP_CONTEXTS = 1 << 20, 512
_ANCHOR = RollingHash(61)
_WINDOW = RollingHash(63)


def anchor_width(least: int) -> int:
    return max(8, least // 3)


def contexts_of(data: np.ndarray, offsets: np.ndarray, least: int, width: int):
    """Anchor hash, text, first window and end of the last window of every context of a batch.

    The texts lie one after the other; windows that cross a boundary are left out.
    """
    if len(data) < least:
        none = np.zeros(0, np.int64)
        return none.view(np.uint64), none, none, none
    hashes = _ANCHOR.windows(_ANCHOR.sums(data), width)
    anchor = sliding_argmin(hashes, least - width + 1)
    start = np.arange(len(anchor))
    text = np.searchsorted(offsets, start, "right") - 1
    inside = start + least <= offsets[text + 1]
    start, anchor, text = start[inside], anchor[inside], text[inside]
    if not len(start):
        return hashes[:0], start, start, start
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    return hashes[anchor[first]], text[first], start[first], start[last] + least


def _pieces(data: np.ndarray, offsets: np.ndarray, least: int):
    """Bounded stretches of a batch: first text, bytes, offsets, place in the first text.

    A text beyond the bound is cut into stretches that overlap by one byte less than a window.
    """
    limit, low, rows = PASS_BYTES, 0, len(offsets) - 1
    while low < rows:
        size = int(offsets[low + 1] - offsets[low])
        if size > limit:
            for at in range(0, size - least + 1, limit):
                end = min(size, at + limit + least - 1)
                part = data[offsets[low] + at : offsets[low] + end]
                yield low, part, np.array([0, len(part)]), at
            low += 1
            continue
        high = max(int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1, low + 1)
        high = min(high, rows)
        yield low, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], 0
        low = high


_CONTEXT = "doc_id long, row_key long, anchor long, h1 long, h2 long, start int, end int"


def _anchors(least: int):
    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for low, part, marks, shift in _pieces(data, offsets, least):
                hashes, text, start, end = contexts_of(part, marks, least, anchor_width(least))
                raw = memoryview(part.tobytes())
                digests = [
                    xxhash.xxh3_128_digest(raw[a:b]) for a, b in zip(start.tolist(), end.tolist())
                ]
                both = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                rows = pa.array(text + low)
                base = marks[text] - shift
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(rows), batch.column("row_key").take(rows),
                        pa.array(hashes.view(np.int64)), pa.array(both[:, 0].copy()),
                        pa.array(both[:, 1].copy()),
                        pa.array((start - base).astype(np.int32)),
                        pa.array((end - base).astype(np.int32)),
                    ],
                    ["doc_id", "row_key", "anchor", "h1", "h2", "start", "end"],
                )

    return anchors


def _suffixes(text: np.ndarray) -> np.ndarray:
    """Order of all suffixes, by doubling: first by 7 bytes, then by the ranks of two halves.

    All separators count as one number here.
    """
    size = len(text)
    text = np.minimum(text, 256)
    rank = np.zeros(size, np.int64)
    for k in range(7):
        rank <<= 9
        rank[: size - k] |= text[k:].astype(np.int64)
    order = np.argsort(rank, kind="stable")
    new = np.ones(size, bool)
    new[1:] = rank[order[1:]] != rank[order[:-1]]
    rank = np.empty(size, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(size), 0))
    span = 7
    while not new.all():
        # only suffixes that still tie are sorted again
        tied = ~new
        tied[:-1] |= ~new[1:]
        places = np.flatnonzero(tied)
        who = order[places]
        ahead = np.where(who + span < size, rank[np.minimum(who + span, size - 1)], -1)
        again = np.lexsort((ahead, rank[who]))
        order[places] = who[again]
        who, ahead = who[again], ahead[again]
        new[places[1:]] |= (ahead[1:] != ahead[:-1]) | (rank[who[1:]] != rank[who[:-1]])
        rank[order] = np.maximum.accumulate(np.where(new, np.arange(size), 0))
        span *= 2
    return order


def _common(text: np.ndarray, one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Lengths of the common beginnings of pairs of different suffixes; separators end them."""
    length = np.zeros(len(one), np.int64)
    alive = np.arange(len(one))
    step = np.arange(32)
    while len(alive):
        a = np.minimum(one[alive, None] + length[alive, None] + step, len(text) - 1)
        b = np.minimum(other[alive, None] + length[alive, None] + step, len(text) - 1)
        differ = text[a] != text[b]
        found = differ.any(axis=1)
        length[alive] += np.where(found, differ.argmax(axis=1), len(step))
        alive = alive[~found]
    return length


def matching_statistics(text: np.ndarray) -> np.ndarray:
    """Each suffix's longest common beginning with any other suffix.

    Separators must be numbers that occur once. The transform is reduced to its runs; lengths are
    compared at the sampled run ends only and fall by one per byte in between.
    """
    order = _suffixes(text)
    transform = text[order - 1]
    turns = np.flatnonzero(transform[1:] != transform[:-1]) + 1
    first, last = order[turns], order[turns - 1]  # samples: a run's start, the end of the one before
    length = _common(text, first, last)
    best = np.zeros(len(text), np.int64)
    places = np.arange(len(text))
    for sample in (first, last):
        # a sample at p of length l stands for l - (q - p) at every q until the next sample
        by_place = np.argsort(sample)
        at, value = sample[by_place], length[by_place]
        nearest = np.searchsorted(at, places, "right") - 1
        known = nearest >= 0
        fall = places - at[np.maximum(nearest, 0)]
        np.maximum(best, np.where(known, value[np.maximum(nearest, 0)] - fall, 0), out=best)
    return best


def _index(least: int):
    """Matches of contexts that come sorted by anchor, a bounded number of bytes at a time."""

    def settle(group: list[tuple]) -> Iterator[tuple[list, np.ndarray]]:
        sizes = [len(row[-1]) for row in group]
        text = np.empty(sum(sizes) + len(group), np.int32)
        at, marks = 0, []
        for k, (row, size) in enumerate(zip(group, sizes)):
            text[at : at + size] = np.frombuffer(row[-1], np.uint8)
            # separators sort after all bytes, and no two are equal
            text[at + size] = 256 + k
            marks.append(at)
            at += size + 1
        found = matching_statistics(text)
        for row, at, size in zip(group, marks, sizes):
            hit = np.flatnonzero(found[at : at + size - least + 1] >= least)
            if len(hit) and row[5]:
                cut = np.flatnonzero(np.diff(hit) > 1)
                starts = hit[np.append(0, cut + 1)]
                ends = hit[np.append(cut, len(hit) - 1)] + least
                yield row, np.stack([starts, ends], axis=1) + row[3]

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        size = 0
        for batch in itertools.chain(batches, [None]):
            rows = [] if batch is None else zip(*(c.to_pylist() for c in batch.columns))
            done = []
            for row in rows:
                if size >= INDEX_BYTES and row[0] != group[-1][0]:
                    done += settle(group)
                    group, size = [], 0
                group.append(row)
                size += len(row[-1])
            if batch is None and group:
                done += settle(group)
            flat = [(r[1], r[2], int(a), int(b)) for r, spans in done for a, b in spans]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(
                    zip(*flat) if flat else ((), (), (), ()),
                    (pa.int64(), pa.int64(), pa.int32(), pa.int32()),
                )],
                ["doc_id", "row_key", "start", "end"],
            )

    return index


def _parts_of_contexts(least: int):
    """Split contexts by wide anchors; each part carries the digests of its windows."""
    width = least - max(1, least // 20)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("context"))
            for low, part, marks, shift in _pieces(data, offsets, least):
                hashes, text, start, end = contexts_of(part, marks, least, width)
                raw = memoryview(part.tobytes())
                digest = [xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip(start, end)]
                counts = end - start - least + 1
                cuts = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
                at = np.repeat(start - np.asarray(cuts)[:-1], counts) + np.arange(counts.sum())
                windows = [
                    pa.ListArray.from_arrays(
                        cuts, pa.array(h.spans(h.sums(part), at, at + least).view(np.int64))
                    )
                    for h in (_ANCHOR, _WINDOW)
                ]
                rows = pa.array(text + low)
                first = batch.column("start").take(rows).to_numpy() + start - marks[text] + shift
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).take(rows) for c in ("doc_id", "row_key", "single")),
                        pa.array(hashes.view(np.int64)),
                        pa.array(np.array(digest, np.uint64).view(np.int64)),
                        pa.array(first.astype(np.int32)), *windows,
                    ],
                    ["doc_id", "row_key", "single", "anchor", "h", "start", "one", "two"],
                )

    return parts


def _counted(cut: DataFrame, least: int, scratch: Scratch) -> DataFrame:
    """Repeated windows of contexts whose anchor has too many for an index."""
    parts = scratch.write(
        "parts",
        cut.mapInArrow(
            _parts_of_contexts(least),
            "doc_id long, row_key long, single boolean, anchor long, h long, start int, "
            "one array<long>, two array<long>",
        ),
    )
    kinds = parts.groupBy("anchor", "h").agg(
        F.count("*").alias("times"), F.first(F.struct("one", "two")).alias("windows")
    )
    kinds = scratch.write("part-kinds", kinds)
    open_groups = (
        kinds.groupBy("anchor")
        .agg(F.count("*").alias("members"), F.min("times").alias("least"))
        .where("members > 1 and least = 1")
        .select("anchor")
    )
    windows = kinds.join(open_groups, "anchor").select(
        "anchor", "h", "times",
        F.posexplode(F.arrays_zip("windows.one", "windows.two")).alias("at", "w"),
    ).select("anchor", "h", "times", "at", "w.one", "w.two")
    common = windows.groupBy("one", "two").agg(F.count("*").alias("n")).where("n > 1").select(
        "one", "two"
    )
    lone = windows.where("times = 1").join(common, ["one", "two"]).select("anchor", "h", "at")
    singles = parts.where("single")
    some = singles.join(lone, ["anchor", "h"]).select(
        "doc_id", "row_key", (F.col("start") + F.col("at")).alias("start")
    ).withColumn("end", F.col("start") + least)
    whole = singles.join(kinds.where("times > 1").select("anchor", "h"), ["anchor", "h"]).select(
        "doc_id", "row_key", "start", (F.col("start") + F.size("one") + least - 1).alias("end")
    )
    return whole.unionByName(some)


def _cut_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        raw = data.tobytes()
        lists = batch.column("wanted").to_pylist()
        flat = [
            (w["anchor"], row, w["start"], w["end"], w["single"], raw[o + w["start"] : o + w["end"]], w["members"])
            for row, (o, wanted) in enumerate(zip(offsets[:-1].tolist(), lists)) for w in wanted
        ]
        anchor, row, start, end, single, context, members = zip(*flat) if flat else ((),) * 7
        rows = pa.array(row, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(anchor, pa.int64()), batch.column("doc_id").take(rows),
             batch.column("row_key").take(rows), pa.array(start, pa.int32()),
             pa.array(end, pa.int32()), pa.array(single, pa.bool_()),
             pa.array(members, pa.int64()), pa.array(context, pa.binary())],
            ["anchor", "doc_id", "row_key", "start", "end", "single", "members", "context"],
        )


def keyed_texts(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(F.col("doc_id").cast("long"), "text").alias("row_key"), "text",
    )


def repeated_spans(docs: DataFrame, least: int = 400) -> DataFrame:
    """``doc_id, row_key, start, end`` in bytes: stretches covered by repeated strings; they may
    overlap. Rows that agree in id and text share their stretches."""
    scratch = Scratch(docs.sparkSession)
    texts = keyed_texts(docs)
    found = scratch.write("contexts", texts.mapInArrow(_anchors(least), _CONTEXT))
    kinds = scratch.write(
        "kinds",
        found.groupBy("anchor", "h1", "h2").agg(
            F.count("*").alias("times"),
            F.min(F.struct("doc_id", "row_key", "start", "end")).alias("one"),
        ),
    )
    groups = (
        kinds.groupBy("anchor")
        .agg(F.count("*").alias("members"), F.min("times").alias("least"))
        .where("members > 1 and least = 1")
    )
    wanted = (
        kinds.join(groups.select("anchor", "members"), "anchor")
        .select("one.*", "anchor", (F.col("times") == 1).alias("single"), "members")
        .groupBy("doc_id", "row_key")
        .agg(F.collect_list(F.struct("anchor", "start", "end", "single", "members")).alias("wanted"))
    )
    keyed = texts.toDF("d", "k", "text")
    cut = (
        wanted.join(keyed, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("row_key") == F.col("k")))
        .dropDuplicates(["doc_id", "row_key"])
        .select("doc_id", "row_key", "text", "wanted")
        .mapInArrow(
            _cut_contexts,
            "anchor long, doc_id long, row_key long, start int, end int, single boolean, "
            "members long, context binary",
        )
    )
    cut = scratch.write("cut", cut)
    span = "doc_id long, row_key long, start int, end int"
    indexed = (
        cut.where(F.col("members") <= GROUP_CONTEXTS)
        .repartition("anchor")
        .sortWithinPartitions("anchor")
        .select("anchor", "doc_id", "row_key", "start", "end", "single", "context")
        .mapInArrow(_index(least), span)
    )
    counted = _counted(cut.where(F.col("members") > GROUP_CONTEXTS), least, scratch)
    several = kinds.where("times > 1").select("anchor", "h1", "h2")
    whole = found.join(several, ["anchor", "h1", "h2"]).select(
        "doc_id", "row_key", "start", "end"
    )
    # written, so that what it was found in can go before texts move again
    spans = scratch.write("spans", whole.unionByName(indexed).unionByName(counted).distinct())
    for name in ("contexts", "kinds", "cut"):
        scratch.drop(name)
    return spans


def merged(spans: list[dict]) -> list[tuple[int, int]]:
    """Sorted, disjoint stretches; those that touch become one."""
    out: list[tuple[int, int]] = []
    for start, end in sorted((s["start"], s["end"]) for s in spans or ()):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def passages(spans: list[dict], least: int) -> list[tuple[int, int]]:
    """Sorted repeated strings at full length: windows that follow each other byte by byte are one.

    Two strings that only touch, or overlap by less than a window but one byte, stay two.
    """
    out: list[tuple[int, int]] = []
    for start, end in sorted((s["start"], s["end"]) for s in spans or ()):
        if out and start + least <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def with_spans(docs: DataFrame, least: int) -> DataFrame:
    """``row`` (all columns) and ``spans``: its repeated stretches, null for none."""
    spans = (
        repeated_spans(docs, least)
        .groupBy("doc_id", "row_key")
        .agg(F.collect_list(F.struct("start", "end")).alias("spans"))
        .toDF("id", "key", "spans")
    )
    # the row as one column, so that no name of the table can clash
    rows = docs.select(
        F.xxhash64(F.col("doc_id").cast("long"), F.col("text")).alias("own"), F.struct(*docs.columns).alias("row")
    )
    same = F.col("row.doc_id").cast("long").eqNullSafe(F.col("id")) & (F.col("own") == F.col("key"))
    return rows.join(spans, same, "left").select("row", "spans")


def cut_repeats(docs: DataFrame, least: int = 400) -> DataFrame:
    """Every text without its repeated strings: ``doc_id, n_bytes`` (of the whole text), ``spans`` (what is
    removed: sorted, disjoint, in bytes) and ``kept`` (the remaining bytes, concatenated)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("row")
            data, offsets = utf8(rows.field("text"))
            gone = [merged(spans) for spans in batch.column("spans").to_pylist()]
            kept = []
            for k, stretches in enumerate(gone):
                raw, rest, at = data[offsets[k] : offsets[k + 1]].tobytes(), [], 0
                for start, end in stretches:
                    rest.append(raw[at:start])
                    at = end
                kept.append(b"".join([*rest, raw[at:]]))
            spans = [[{"start": a, "end": b} for a, b in stretches] for stretches in gone]
            yield pa.RecordBatch.from_arrays(
                [rows.field("doc_id"), pa.array(np.diff(offsets), pa.int64()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                 pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "spans", "kept"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return with_spans(docs.select("doc_id", "text"), least).mapInArrow(
        cut,
        f"doc_id {kind}, n_bytes long, spans array<struct<start: int, end: int>>, kept binary",
    )


def digest_columns() -> list[Column]:
    """``n_bytes, n_removed, n_spans, kept_sha256`` of ``cut_repeats``."""
    return [
        F.col("n_bytes"),
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    ]


def removed_digest(docs: DataFrame, least: int = 400) -> DataFrame:
    """What is left of each text: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``."""
    return cut_repeats(docs, least).select("doc_id", *digest_columns())


def without_repeats(docs: DataFrame, least: int = 200, least_words: int = 50) -> DataFrame:
    """The documents without repeated passages of ``least_words`` words or more; all rows stay.

    Passages are found as strings of ``least`` bytes, and words are counted in each by itself: short ones
    that touch are not added up. A removed stretch covers whole characters.
    """

    names, place = docs.columns, docs.columns.index("text")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            spans, rows = batch.column("spans").to_pylist(), batch.column("row")
            for text, found in zip(rows.field(place).to_pylist(), spans):
                if found:
                    raw, kept, at = text.encode(), [], 0
                    long = [
                        {"start": start, "end": end}
                        for start, end in passages(found, least)
                        if len(raw[start:end].split()) >= least_words
                    ]
                    for start, end in merged(long):
                        kept.append(raw[at:start])
                        at = end
                    kept.append(raw[at:])
                    text = b"".join(p.decode(errors="ignore").encode() for p in kept).decode()
                texts.append(text)
            columns = rows.flatten()
            columns[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names)

    return with_spans(docs, least).mapInArrow(clean, docs.schema)

"""Near-duplicate documents: minhash with tensored banding, confirmed on the full shingle sets.

Two small collections of minhash pairs are drawn per text. A table key joins one entry of the first
with one of the second, so ``SIDE * SIDE`` tables need ``4 * SIDE`` minhashes in place of
``4 * SIDE * SIDE``. A pair of texts at the contract's threshold of 0.85 shares no table with a
chance of about ``2 * (1 - 0.85 ** 2) ** SIDE`` (7e-5); at 0.8 it is 6e-4.

Texts with equal shingle sets are one node from the start. Candidates are never all pairs of a
table: each node is first held against the table member that shares most tables with others, links
are turned into components, and only pairs of different components that still meet are held against
each other, each pair once however many tables it shares.

Defined results: null or blank texts have no shingles, and each is a group of its own; rows with
equal texts are always in one group; rows that share an id but not the text are told apart by their
text; a null id is the smallest only where all ids of a group are null. Columns other than the id
and the text are neither read nor needed, whatever their names.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbstar.llm.common import Scratch, passes, random_words, shingle_hashes, utf8
from curbstar.llm.components import components

#: Entries of each collection, and minhashes of an entry.
SIDE, ROWS = 8, 2
#: One-bit minhashes that reject dissimilar candidates before any text is moved: of every text, and
#: of texts that still meet others after the first round.
SKETCH_BITS, WIDE_BITS = 64, 4096
#: Members of one table key that are held against each other in one task.
CHUNK_ROWS = 2048

_BLEND, _SCALE = random_words(21, 2 * SIDE * ROWS), random_words(22, 2 * SIDE * ROWS, odd=True)
_BLEND_BITS, _SCALE_BITS = random_words(23, WIDE_BITS), random_words(24, WIDE_BITS, odd=True)
_CHUNK = 1 << 8

_SIGNATURE = (
    "doc_id long, row_key long, n_shingles long, h1 long, h2 long, "
    "left array<long>, right array<long>, sketch long"
)


def _minima(shingles: np.ndarray, blend: np.ndarray, scale: np.ndarray) -> np.ndarray:
    least = np.full(len(blend), 2**64 - 1, np.uint64)
    for low in range(0, len(shingles), _CHUNK):
        part = shingles[low : low + _CHUNK]
        np.minimum(least, ((part ^ blend[:, None]) * scale[:, None]).min(axis=1), out=least)
    return least


def _one_bits(shingles: np.ndarray, bits: int) -> np.ndarray:
    """The lowest bits of ``bits`` minhashes, packed into 64-bit numbers."""
    least = _minima(shingles, _BLEND_BITS[:bits], _SCALE_BITS[:bits]) >> np.uint64(40)
    return np.packbits((least & np.uint64(1)).astype(np.uint8)).view(np.int64)


def _signed(values) -> np.ndarray:
    return np.asarray(values, np.uint64).view(np.int64)


def _lists(rows: list[np.ndarray], width: int) -> pa.Array:
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(
        pa.array(np.arange(0, width * len(rows) + 1, width), pa.int32()), pa.array(flat)
    )


def _signatures(words: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for low, high, part, marks in passes(data, offsets):
                sizes, digests, left, right, sketches = [], [], [], [], []
                for shingles in shingle_hashes(part, marks, words):
                    pairs = _minima(shingles, _BLEND, _SCALE).reshape(2, SIDE, ROWS)
                    folded = (pairs[..., 0] * np.uint64(3) ^ pairs[..., 1]).view(np.int64)
                    sizes.append(len(shingles))
                    digests.append(xxhash.xxh3_128_intdigest(shingles.tobytes()))
                    left.append(folded[0])
                    right.append(folded[1])
                    sketches.append(_one_bits(shingles, SKETCH_BITS))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(low, high - low),
                        batch.column("row_key").slice(low, high - low),
                        pa.array(sizes, pa.int64()),
                        pa.array(_signed([d >> 64 for d in digests])),
                        pa.array(_signed([d & (2**64 - 1) for d in digests])),
                        _lists(left, SIDE),
                        _lists(right, SIDE),
                        pa.array(np.concatenate(sketches)),
                    ],
                    ["doc_id", "row_key", "n_shingles", "h1", "h2", "left", "right", "sketch"],
                )

    return sign


def _wide_sketches(words: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for low, high, part, marks in passes(data, offsets):
                rows = [
                    _one_bits(s, WIDE_BITS).tobytes() for s in shingle_hashes(part, marks, words)
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node").slice(low, high - low), pa.array(rows, pa.binary())],
                    ["node", "wide"],
                )

    return sketch


def _confirm(words: int, percent: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = []
            for name in ("a_text", "b_text"):
                data, offsets = utf8(batch.column(name))
                sides.append(
                    s for _, _, part, marks in passes(data, offsets)
                    for s in shingle_hashes(part, marks, words)
                )
            linked = []
            for one, other in zip(*sides):
                if len(one) > len(other):
                    one, other = other, one
                at = np.searchsorted(other, one)
                at[at == len(other)] = 0
                both = int((other[at] == one).sum()) if len(other) else 0
                linked.append(100 * both >= percent * (len(one) + len(other) - both) > 0)
            kept = pa.array(linked, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(kept), batch.column("b").filter(kept)], ["a", "b"]
            )

    return confirm


def _texts_of(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """``node, text`` of the given nodes."""
    same = F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("k") == F.col("row_key"))
    found = nodes.select("node", F.col("doc_id").alias("d"), F.col("row_key").alias("k"))
    # one plan at every size: texts move once, whether or not the nodes could be broadcast
    return found.join(texts.hint("merge"), same).select("node", "text").dropDuplicates(["node"])


def _confirmed(pairs: DataFrame, met_texts: DataFrame, words: int, percent: int):
    """The pairs ``a, b`` whose full shingle sets are similar enough."""
    both = pairs.join(met_texts.toDF("a", "a_text"), "a").join(met_texts.toDF("b", "b_text"), "b")
    return both.select("a", "b", "a_text", "b_text").mapInArrow(
        _confirm(words, percent), "a long, b long"
    )


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col="text"
) -> DataFrame:
    """Groups of similar texts: ``doc_id, row_key, n_shingles, component_id, chosen``.

    Two texts are linked where ``100 * intersection >= percent * union`` of their distinct word
    shingles; ``component_id`` is the smallest id reachable over links. ``row_key`` is a hash of id
    and text; ``chosen`` holds for one row key of each group.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(F.col(id_col).cast("long"), F.col(text_col)).alias("row_key"),
        F.col(text_col).alias("text"),
    )
    signed = texts.mapInArrow(_signatures(words), _SIGNATURE)
    signed = scratch.write("signed", signed.withColumn("row", F.monotonically_increasing_id()))
    nodes = scratch.write(
        "nodes",
        signed.where("n_shingles > 0")
        .groupBy("h1", "h2")
        .agg(
            F.min(F.struct("row", "doc_id", "row_key")).alias("first"),
            *(F.first(c).alias(c) for c in ("n_shingles", "left", "right", "sketch")),
        )
        .select(
            F.col("first.row").alias("node"), "first.doc_id", "first.row_key",
            "h1", "h2", "n_shingles", "left", "right", "sketch",
        ),
    )

    keyed = nodes.select("node", "right", F.posexplode("left").alias("i", "x")).select(
        "node", "i", "x", F.posexplode("right").alias("j", "y")
    ).select(
        F.xxhash64("i", "j", "x", "y").alias("key"),
        (F.col("i") * SIDE + F.col("j")).alias("table"),
        "node",
    )
    shared = keyed.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    met = scratch.write("met", keyed.join(shared, "key"))

    weight = met.groupBy("node").agg(F.sum("members").alias("weight"))
    slim = scratch.write(
        "slim",
        nodes.join(weight, "node").select(
            "node", "doc_id", "row_key", "weight", "n_shingles", "sketch"
        ),
    )
    # all texts move once; what follows reads only those that share a table
    met_texts = scratch.write("texts", _texts_of(slim, texts))
    centres = (
        met.join(slim.select("node", "weight", "n_shingles", "sketch"), "node")
        .groupBy("key")
        .agg(F.max(F.struct("weight", -F.col("node"), "n_shingles", "sketch")).alias("c"))
        .select("key", (-F.col("c.col2")).alias("b"), "c.weight", "c.n_shingles", "c.sketch")
        .toDF("key", "b", "b_weight", "b_size", "b_sketch")
    )
    alike = _may_link(percent, SKETCH_BITS, _same_bits())
    starred = (
        met.join(centres, "key")
        .where("node != b")
        .join(slim.select("node", F.col("n_shingles").alias("a_size"),
                          F.col("sketch").alias("a_sketch")), "node")
        .where(alike)
        .groupBy("node")
        .agg(
            F.max_by("b", F.struct("b_weight", F.col("b"))).alias("central"),
            F.max_by("b", F.struct(_same_bits(), F.col("b"))).alias("nearest"),
        )
        .select(
            F.col("node").alias("a"),
            F.explode(F.array_distinct(F.array("central", "nearest"))).alias("b"),
        )
    )
    links = scratch.write("links-1", _confirmed(starred, met_texts, words, percent))
    roots = scratch.write("roots-1", components(links, scratch, "stars"))

    placed = met.join(roots, "node", "left").select(
        "key", "table", "node", F.coalesce("root", "node").alias("root")
    )
    # of each table key's members, those outside its largest component are held against the others
    counted = placed.groupBy("key", "root").agg(F.count("*").alias("members"))
    mixed = (
        counted.groupBy("key")
        .agg(F.count("*").alias("roots"), F.max(F.struct("members", "root"))["root"].alias("main"))
        .where("roots > 1")
        .select("key", "main")
    )
    open_rows = scratch.write(
        "open",
        placed.join(mixed, "key").withColumn("outside", F.col("root") != F.col("main")).drop("main"),
    )
    wide = scratch.write(
        "wide",
        met_texts.join(open_rows.select("node").distinct(), "node").mapInArrow(
            _wide_sketches(words), "node long, wide binary"
        ),
    )
    crossed = (
        _blocks(open_rows)
        .join(nodes.select("node", "n_shingles", "left", "right"), "node")
        .join(wide, "node")
        .repartition("block")
        .sortWithinPartitions("block")
        .mapInArrow(_cross(percent), "a long, b long")
    )
    more = _confirmed(crossed, met_texts, words, percent)
    links = scratch.write("links-2", links.unionByName(more))
    roots = scratch.write("roots-2", components(links, scratch, "all"))

    grouped = scratch.write(
        "grouped",
        signed.join(nodes.select("h1", "h2", "node"), ["h1", "h2"], "left")
        .join(roots, "node", "left")
        .select(
            "doc_id", "row_key", "n_shingles", F.coalesce("root", "node", "row").alias("root"),
            F.when(F.col("n_shingles") == 0, F.col("row")).alias("single"),
        ),
    )
    first = grouped.groupBy("root", "single").agg(
        F.min("doc_id").alias("component_id"),
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key"))["row_key"].alias("chosen"),
    )
    return (
        grouped.alias("g")
        .join(first.alias("f"), (F.col("g.root") == F.col("f.root"))
              & F.col("g.single").eqNullSafe(F.col("f.single")))
        .select(
            "doc_id", "row_key", "n_shingles", "component_id",
            (F.col("doc_id").eqNullSafe(F.col("component_id"))
             & (F.col("row_key") == F.col("chosen"))).alias("chosen"),
        )
    )


def _same_bits():
    return SKETCH_BITS - F.bit_count(F.col("a_sketch").bitwiseXOR(F.col("b_sketch")))


def _may_link(percent: int, bits: int, same):
    """What any linked pair fulfils, but for a chance below 1e-6."""
    share = (1 + percent / 100) / 2
    least = int(bits * share - 5 * (bits * share * (1 - share)) ** 0.5)
    small, large = F.least("a_size", "b_size"), F.greatest("a_size", "b_size")
    return (100 * small >= percent * large) & (same >= least)


def _blocks(rows: DataFrame) -> DataFrame:
    """Deal a table key's members into chunks of bounded size, and each pair of chunks to a block."""
    chunks = rows.groupBy("key").agg(
        F.ceil(F.count("*") / F.lit(CHUNK_ROWS)).cast("int").alias("chunks")
    )
    dealt = rows.join(chunks, "key").withColumn(
        "chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    )
    return dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(
        F.xxhash64("key", F.least("chunk", "other"), F.greatest("chunk", "other")).alias("block"),
        "key", "table", "node", "root", "outside", "chunk",
        (F.col("chunk") == F.col("other")).alias("own"),
    )


def _cross(percent: int):
    """Pairs of each block that may link, each in the first table that it shares.

    The rows come sorted by block; a block's name is a hash, so the table key is compared as well.
    """
    share = (1 + percent / 100) / 2
    most_off = WIDE_BITS - int(
        WIDE_BITS * share - 5 * (WIDE_BITS * share * (1 - share)) ** 0.5
    )

    def rows_of(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        rows = {
            c: batch.column(c).to_numpy(zero_copy_only=False)
            for c in ("block", "key", "table", "node", "root", "outside", "chunk", "own",
                      "n_shingles")
        }
        for c in ("left", "right"):
            rows[c] = batch.column(c).flatten().to_numpy().reshape(-1, SIDE)
        packed = b"".join(batch.column("wide").to_pylist())
        rows["wide"] = np.frombuffer(packed, np.uint64).reshape(-1, WIDE_BITS // 64)
        return rows

    def partners(rows: dict[str, np.ndarray], low: int, high: int, one: int) -> np.ndarray:
        """Rows of ``low`` to ``high`` that row ``one`` is to be confirmed with."""
        column = {c: v[low:high] for c, v in rows.items()}
        off = np.bitwise_count(column["wide"] ^ rows["wide"][one]).sum(axis=1, dtype=np.int64)
        sizes, size = column["n_shingles"], rows["n_shingles"][one]
        fits = (
            (off <= most_off)
            & (column["root"] != rows["root"][one])
            & (column["key"] == rows["key"][one])
            & (100 * np.minimum(sizes, size) >= percent * np.maximum(sizes, size))
            & (~column["outside"] | (column["node"] > rows["node"][one]))
            & (column["own"] | (column["chunk"] != rows["chunk"][one]))
        )
        found = np.flatnonzero(fits)
        if len(found):
            i = (column["left"][found] == rows["left"][one]).argmax(axis=1)
            j = (column["right"][found] == rows["right"][one]).argmax(axis=1)
            found = found[i * SIDE + j == rows["table"][one]]
        return found + low

    def cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in itertools.chain(batches, [None]):
            rows = held if batch is None else rows_of(batch)
            if batch is not None and held is not None:
                rows = {c: np.concatenate([held[c], rows[c]]) for c in rows}
            if rows is None or not len(rows["block"]):
                continue
            cuts = np.flatnonzero(np.diff(rows["block"])) + 1
            cuts = np.concatenate([[0], cuts, [len(rows["block"])]])
            if batch is not None:
                cuts, last = cuts[:-1], cuts[-2]
                held = {c: v[last:] for c, v in rows.items()}
            ones, others = [], []
            for low, high in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                for one in (np.flatnonzero(rows["outside"][low:high]) + low).tolist():
                    found = partners(rows, low, high, one)
                    others.append(rows["node"][found])
                    ones.append(np.full(len(found), rows["node"][one]))
            if ones:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x).astype(np.int64)) for x in (ones, others)],
                    ["a", "b"],
                )

    return cross


def keep_one_of_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The documents without near-duplicates: one row of each group, with all its columns."""
    chosen = (
        near_duplicates(docs, words, percent)
        .where("chosen")
        .select(F.col("doc_id").alias("id"), F.col("row_key").alias("key"))
        .distinct()
    )
    # the row as one column, so that no name of the table can clash
    rows = docs.select(
        F.xxhash64(F.col("doc_id").cast("long"), F.col("text")).alias("own"), F.struct(*docs.columns).alias("row")
    )
    same = F.col("row.doc_id").cast("long").eqNullSafe(F.col("id")) & (F.col("own") == F.col("key"))
    return rows.join(chosen, same).dropDuplicates(["id", "key"]).select("row.*")

"""Packing tokenized documents into sequences: linear grouping, then best fit.

Documents are cut into pieces of at most ``length`` tokens. Pieces are dealt by hash into cells of
bounded size, and each cell is packed on its own: pieces longer than an eighth of a sequence are
sorted into groups of equal cardinality and rounded up to the largest of their group; the linear
program over configurations of these few sizes is solved by column generation; the whole parts of
its solution are filled with actual pieces of the groups; whatever is left, the small pieces among
them, goes where it fits best. A cell loses about one sequence at most, against thousands in it.

Defined results: a null or blank text is one piece that holds the end token only; repeated rows are
packed as separate documents; an empty table gives no rows; a special token written in a text gets its
own id, as the tokenizer does by default.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbstar.llm.common import RollingHash, Scratch, lower_ascii, passes, utf8, word_bounds

SEQUENCE, END_TOKEN = 4096, 1
#: Pieces of a cell; groups of large pieces; sizes of the linear program are multiples of UNIT.
CELL_ROWS, GROUPS, UNIT = 20_000, 48, 8
#: Words and ids that a task keeps before it starts anew; longer words are not kept.
CACHE_WORDS, CACHE_IDS, WORD_BYTES = 1_000_000, 8_000_000, 256
#: Words that one call of the tokenizer takes.
JOINED_WORDS = 512

_KEYS, _CHECKS = RollingHash(101), RollingHash(103)


class WordIds:
    """Token ids of texts by way of their words.

    The tokenizer drops white space and never merges across it, so a text's ids are those of its
    words one after the other. Words are told apart by two 64-bit hashes and looked up all at once;
    the ids of those met before lie one after the other in one array.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        #: Special tokens in lower case; the tokenizer finds them as they are written.
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = [t.content.lower().encode() for t in added.values()]
        self.mark_id = min(i for i, t in added.items() if t.special)
        self.mark = added[self.mark_id].content.encode()
        self._forget()

    def _forget(self) -> None:
        self.keys, self.checks = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.starts, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words one after the other, and how many each has.

        Many words make one call, a special token between them: nothing merges across it, and its id
        tells where a word ends. Words that hold a special token are encoded one by one.
        """
        ids, counts = [], []
        for low in range(0, len(words), JOINED_WORDS):
            some = words[low : low + JOINED_WORDS]
            whole = b"\n".join(some).lower()
            if not any(t in whole for t in self.special):
                joined = [self.mark.join(some).decode()]
                found = self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)
                of_all = np.array(found[0].ids + [self.mark_id], np.uint32)
                ends = np.flatnonzero(of_all == self.mark_id)
                ids.append(of_all[of_all != self.mark_id])
                counts.append(np.diff(ends, prepend=-1) - 1)
            else:
                found = self.tokenizer.encode_batch(
                    [w.decode() for w in some], add_special_tokens=False
                )
                ids.append(np.array([i for f in found for i in f.ids], np.uint32))
                counts.append(np.array([len(f.ids) for f in found], np.int64))
        return np.concatenate(ids), np.concatenate(counts)

    def _lowered(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The bytes in lower case, as the tokenizer puts them, but for words that may hold a special
        token."""
        small = lower_ascii(data)
        raw = small.tobytes()
        for token in self.special:
            at = raw.find(token)
            while at >= 0:
                word = int(np.searchsorted(starts, at, "right")) - 1
                if ends[word] >= at + len(token):
                    small[starts[word] : ends[word]] = data[starts[word] : ends[word]]
                at = raw.find(token, max(at + 1, int(ends[word])))
        return small

    def of(self, data: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and where each text's begin."""
        starts, ends, firsts = word_bounds(data, marks)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(marks), np.int64)
        if len(self.keys) > CACHE_WORDS or len(self.ids) > CACHE_IDS:
            self._forget()
        data = self._lowered(data, starts, ends)
        key = _KEYS.spans(_KEYS.sums(data), starts, ends)
        check = _CHECKS.spans(_CHECKS.sums(data), starts, ends)
        kind_of, kinds = pd.factorize(key)
        first = np.zeros(len(kinds), np.int64)
        first[kind_of[::-1]] = np.arange(len(key))[::-1]
        # words that are too long to keep, or share one hash but not the other, stand for themselves
        alone = np.flatnonzero((ends - starts > WORD_BYTES) | (check != check[first][kind_of]))

        spot = np.minimum(np.searchsorted(self.keys, kinds), max(0, len(self.keys) - 1))
        if len(self.keys):
            known = (self.keys[spot] == kinds) & (self.checks[spot] == check[first])
        else:
            known = np.zeros(len(kinds), bool)
        new = np.flatnonzero(~known & (ends[first] - starts[first] <= WORD_BYTES))
        new = new[np.argsort(kinds[new])]
        start, count = np.zeros(len(kinds), np.int64), np.zeros(len(kinds), np.int64)
        start[known], count[known] = self.starts[spot[known]], self.counts[spot[known]]
        if len(new):
            at = first[new]
            words = [data[a:b].tobytes() for a, b in zip(starts[at].tolist(), ends[at].tolist())]
            ids, count[new] = self._encode(words)
            start[new] = len(self.ids) + np.cumsum(count[new]) - count[new]
            self.ids = np.concatenate([self.ids, ids])
            keys = np.concatenate([self.keys, kinds[new]])
            order = np.argsort(keys, kind="stable")
            self.keys = keys[order]
            self.checks = np.concatenate([self.checks, check[at]])[order]
            self.starts = np.concatenate([self.starts, start[new]])[order]
            self.counts = np.concatenate([self.counts, count[new]])[order]

        start, count, stock = start[kind_of], count[kind_of], self.ids
        if len(alone):
            words = [data[a:b].tobytes() for a, b in zip(starts[alone], ends[alone])]
            ids, count[alone] = self._encode(words)
            start[alone] = len(stock) + np.cumsum(count[alone]) - count[alone]
            stock = np.concatenate([stock, ids])
        bounds = np.concatenate([[0], np.cumsum(count)])
        places = np.repeat(start - bounds[:-1], count) + np.arange(bounds[-1])
        return stock[places], bounds[firsts]


_WORD_IDS: dict[str, WordIds] = {}


def _word_ids(path: str) -> WordIds:
    """One tokenizer with its recent words per worker process."""
    if path not in _WORD_IDS:
        _WORD_IDS[path] = WordIds(path)
    return _WORD_IDS[path]


def _cut(path: str, length: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _word_ids(path)
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            docs = batch.column("doc_id")
            for low, high, part, marks in passes(data, offsets):
                found, bounds = ids.of(part, marks)
                # an end token after each text
                tokens = np.insert(found, bounds[1:], END_TOKEN).astype("<u4")
                bounds = bounds + np.arange(len(bounds))
                pieces = -(-np.diff(bounds) // length)
                row = np.repeat(np.arange(high - low), pieces)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * length
                ends = np.minimum(bounds[row] + start + length, bounds[row + 1])
                view = memoryview(tokens).cast("B")
                sums = [
                    zlib.crc32(view[4 * a : 4 * b])
                    for a, b in zip((bounds[row] + start).tolist(), ends.tolist())
                ]
                sizes = ends - bounds[row] - start
                yield pa.RecordBatch.from_arrays(
                    [docs.take(pa.array(row + low)), pa.array(piece, pa.int32()),
                     pa.array(start), pa.array(sizes), pa.array(sums, pa.int64())],
                    ["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return cut


def _configurations(sizes: np.ndarray, counts: np.ndarray, room: int) -> list[tuple[np.ndarray, int]]:
    """Configurations of few sizes and how often to use each: the whole parts of the LP's solution.

    Column generation: the duals of the current basis price a knapsack, whose best filling enters.
    """
    kinds = len(sizes)
    basis = np.diag(room // sizes).astype(float)
    for _ in range(20 * kinds):
        inverse = np.linalg.inv(basis)
        amounts, prices = inverse @ counts, inverse.sum(axis=0)
        worth, last = np.zeros(room + 1), np.full(room + 1, -1)
        for space in range(1, room + 1):
            fits = np.flatnonzero(sizes <= space)
            if len(fits):
                gains = worth[space - sizes[fits]] + prices[fits]
                best = int(gains.argmax())
                if gains[best] > worth[space - 1] + 1e-12:
                    worth[space], last[space] = gains[best], fits[best]
                    continue
            worth[space] = worth[space - 1]
        if worth[room] <= 1 + 1e-6:
            break
        column, space = np.zeros(kinds), room
        while space > 0:
            if last[space] < 0:
                space -= 1
            else:
                column[last[space]] += 1
                space -= sizes[last[space]]
        change = inverse @ column
        rises = np.flatnonzero(change > 1e-9)
        basis[:, rises[np.argmin(np.maximum(amounts[rises], 0) / change[rises])]] = column
    amounts = np.linalg.solve(basis, counts)
    return [
        (basis[:, k].astype(int), int(amounts[k] + 1e-6)) for k in range(kinds) if amounts[k] >= 1
    ]


def pack(lengths: np.ndarray, length: int = SEQUENCE) -> tuple[np.ndarray, np.ndarray]:
    """The sequence and the offset of each piece, for pieces of 1 to ``length`` tokens."""
    order = np.lexsort((np.arange(len(lengths)), -lengths))
    large = order[lengths[order] > length // 8]
    sequence, offset = np.full(len(lengths), -1), np.zeros(len(lengths), int)
    filled: list[int] = []

    def place(piece: int, at: int) -> None:
        sequence[piece], offset[piece] = at, filled[at]
        filled[at] += int(lengths[piece])

    if len(large):
        members = np.array_split(large, min(GROUPS, len(large)))
        sizes = np.array([-(-int(lengths[m[0]]) // UNIT) for m in members])
        kinds, kind_of = np.unique(sizes, return_inverse=True)
        stock = [
            [int(p) for m, k in zip(members, kind_of) if k == kind for p in m][::-1]
            for kind in range(len(kinds))
        ]
        counts = np.array([len(s) for s in stock], float)
        for column, times in _configurations(kinds, counts, length // UNIT):
            for _ in range(times):
                slots = [k for k in np.flatnonzero(column) for _ in range(column[k])]
                if all(stock[k] for k in slots):
                    filled.append(0)
                    for k in slots[::-1]:
                        if stock[k]:
                            place(stock[k].pop(), len(filled) - 1)

    # best fit: sequences by free tokens, and a number whose bits say which amounts occur
    free: list[list[int]] = [[] for _ in range(length + 1)]
    present = 0
    for at, used in enumerate(filled):
        free[length - used].append(at)
        present |= 1 << (length - used)
    for piece in order[sequence[order] < 0].tolist():
        need = int(lengths[piece])
        beyond = present >> need
        if beyond:
            room = need + (beyond & -beyond).bit_length() - 1
            at = free[room].pop()
            if not free[room]:
                present ^= 1 << room
        else:
            room, at = length, len(filled)
            filled.append(0)
        place(piece, at)
        free[room - need].append(at)
        present |= 1 << (room - need)
    return sequence, offset


def _pack_cell(length: int):
    def pack_cell(cell: pd.DataFrame) -> pd.DataFrame:
        cell = cell.sort_values("row")
        sequence, offset = pack(cell["length"].to_numpy(), length)
        return cell.assign(sequence_id=cell["cell"] * 2**32 + sequence, offset=offset).drop(
            columns=["cell", "row"]
        )

    return pack_cell


_PIECE = {"piece": "int", "start": "long", "length": "long", "ids_crc32": "long"}
_PLACE = {"sequence_id": "long", "offset": "long"}


def _schema(docs: DataFrame, columns: dict[str, str]) -> str:
    kind = docs.schema["doc_id"].dataType.simpleString()
    return ", ".join(f"{c} {t}" for c, t in {"doc_id": kind, **columns}.items())


def pack_documents(
    docs: DataFrame, tokenizer_path: str, length: int = SEQUENCE
) -> DataFrame:
    """Every piece of every document with its place: see ``op10`` for the columns.

    ``tokenizer_path`` names a file that all executors have.
    """
    scratch = Scratch(docs.sparkSession)
    pieces = docs.select("doc_id", "text").mapInArrow(
        _cut(tokenizer_path, length),
        _schema(docs, _PIECE),
    )
    pieces = scratch.write("pieces", pieces.withColumn("row", F.monotonically_increasing_id()))
    cells = max(1, -(-pieces.count() // CELL_ROWS))
    return (
        pieces.withColumn("cell", F.pmod(F.xxhash64("row", "doc_id"), F.lit(cells)))
        .groupBy("cell")
        .applyInPandas(_pack_cell(length), _schema(docs, {**_PIECE, **_PLACE}))
    )

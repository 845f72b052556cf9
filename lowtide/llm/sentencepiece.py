"""SentencePiece encoding and decoding with a unigram lattice.

A piece file (path is a parameter) gives pieces and log scores; a double-array
trie over their bytes finds every piece that starts at a position, and Viterbi
picks the sequence of highest score. The white-space marker is the space byte
inside the trie, a text gets one in front, and a character without a piece of
its own costs ``UNKNOWN_PENALTY`` below the lowest score and becomes byte
pieces, so decoding gives every text back exactly (a literal marker too).

Words repeat, so a block of texts is cut before each run of spaces (no piece has
a space after another character; checked on loading), each distinct chunk is
segmented once, and the DP runs over all chunks together, position by position.

Null text: null ids, null text back. Empty text: no ids. Rows are independent,
so repeated rows and ids do not matter; other columns pass through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lowtide.llm.arrays import LEADING, Block, blocks

MARKER = "▁"
UNKNOWN_PENALTY = 10.0
BLOCK = 1 << 20


@dataclass(frozen=True)
class Pieces:
    """Byte pieces by id, their log scores, byte ids, and the trie: ``base``/``check``/``value`` by state."""

    offsets: np.ndarray
    data: np.ndarray
    scores: np.ndarray
    byte_ids: np.ndarray
    base: np.ndarray
    check: np.ndarray
    value: np.ndarray
    inner: np.ndarray
    unknown: float


def double_array(words: list[bytes], values: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Child of state s by byte b is t = base[s] + b + 1 when check[t] == s; value[t] is the word's value or -1."""
    children: list[dict[int, int]] = [{}]
    final = [-1]
    for word, value in zip(words, values):
        node = 0
        for byte in word:
            if byte not in children[node]:
                children[node][byte] = len(children)
                children.append({})
                final.append(-1)
            node = children[node][byte]
        final[node] = value
    size = 8 * len(children) + 1024
    base, check, out = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
    taken = bytearray(size)
    taken[0] = 1
    # single children fill the gaps from the front; larger families search from where the last one was put
    gap, front, todo = 257, 257, [(0, 0)]
    while todo:
        node, state = todo.pop()
        out[state] = final[node]
        if not children[node]:
            continue
        codes = [byte + 1 for byte in sorted(children[node])]
        if len(codes) == 1:
            while taken[gap]:
                gap += 1
            at = gap
        else:
            at = max(front, gap)
            while any(taken[at - codes[0] + c] for c in codes):
                at += 1
            front = at
        base[state] = at - codes[0]
        for c in codes:
            t = at - codes[0] + c
            taken[t] = 1
            check[t] = state
            todo.append((children[node][c - 1], t))
    return base, check, out


@lru_cache(maxsize=4)
def load(path: str, scores: str = "rank") -> Pieces:
    """Read a piece file on the driver.

    ``scores``: "stored" takes the file's numbers as log scores (a unigram
    file); "rank" takes -log(1 + place among the pieces), for files whose
    numbers are merge ranks.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    raw: list[bytes] = []
    byte_ids = np.full(256, -1, np.int32)
    usable, place = [], 0
    values = np.zeros(n)
    for i in range(n):
        text = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(text[3:5], 16)] = i
            raw.append(bytes([int(text[3:5], 16)]))
        elif model.is_control(i) or model.is_unknown(i):
            raw.append(b"")
        else:
            if MARKER in text.lstrip(MARKER) or " " in text:
                raise ValueError(f"piece {i} has a space after another character")
            raw.append(text.replace(MARKER, " ").encode())
            values[i] = model.get_score(i) if scores == "stored" else -np.log1p(place)
            place += 1
            usable.append(i)
    if (byte_ids < 0).any():
        raise ValueError("the file has no byte pieces")
    base, check, value = double_array([raw[i] for i in usable], usable)
    inner = np.zeros(256, bool)
    inner[list({b for i in usable for b in raw[i]})] = True
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in raw])))
    return Pieces(offsets, np.frombuffer(b"".join(raw), np.uint8), values, byte_ids, base, check, value, inner,
                  float(values[usable].min()) - UNKNOWN_PENALTY)


def _flat(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The positions ``starts[i] .. starts[i] + counts[i] - 1``, one after the other."""
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)


def segment(data: np.ndarray, limits: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Best piece ids of each chunk ``limits[i]:limits[i + 1]`` of ``data``: flat ids and offsets by chunk."""
    n = len(data)
    leading = LEADING[data]
    positions = np.flatnonzero(leading)
    width = np.diff(np.append(positions, n))
    stop = np.repeat(limits[1:], np.diff(limits))
    found_at, found_end, found_id = [], [], []
    active, state, depth = positions, np.zeros(len(positions), np.int64), 0
    while len(active):
        inside = active + depth < stop[active]
        active, state = active[inside], state[inside]
        target = pieces.base[state] + data[active + depth].astype(np.int64) + 1
        hit = pieces.check[target] == state
        active, state, depth = active[hit], target[hit], depth + 1
        ids = pieces.value[state]
        done = ids >= 0
        found_at.append(active[done])
        found_end.append(active[done] + depth)
        found_id.append(ids[done])
    at, end, ids = map(np.concatenate, (found_at, found_end, found_id)) if found_at else (positions,) * 3
    char_end = np.zeros(n, np.int64)
    char_end[positions] = positions + width
    known = np.zeros(n, bool)
    known[at[char_end[at] == end]] = True
    alone = positions[~known[positions]]
    at, end = np.concatenate((at, alone)), np.concatenate((end, char_end[alone]))
    ids = np.concatenate((ids, np.full(len(alone), -1, ids.dtype)))
    score = np.where(ids >= 0, pieces.scores[ids], pieces.unknown)

    # the lattice falls apart where no piece crosses; each part starts at zero and is solved by itself
    change = np.bincount(at + 1, minlength=n + 2) - np.bincount(end, minlength=n + 2)
    cut = np.cumsum(change)[: n + 1] == 0
    cut[limits] = True
    cut[:n] &= leading
    cut[n] = True
    cuts = np.flatnonzero(cut)
    place = np.arange(n) - np.repeat(cuts[:-1], np.diff(cuts))
    rank = place[at]
    order = np.argsort(rank.astype(np.uint16) if len(rank) and rank.max() < 1 << 16 else rank, kind="stable")
    at, end, ids, score = at[order], end[order], ids[order], score[order]
    best = np.full(n + 1, -np.inf)
    back = np.full(n + 1, -1, np.int64)
    begun = np.zeros(n + 1)
    begun[:] = -np.inf
    begun[cuts] = 0.0
    steps = np.searchsorted(place[at], np.arange(place.max(initial=-1) + 2))
    for low, high in zip(steps[:-1], steps[1:]):
        if low == high:
            continue
        source = at[low:high]
        total = np.maximum(begun[source], np.where(cut[source], 0.0, best[source])) + score[low:high]
        better = total > best[end[low:high]]
        where = end[low:high][better]
        best[where] = total[better]
        back[where] = np.arange(low, high)[better]
    used, here = [], cuts[1:]
    while len(here):
        edge = back[here]
        used.append(edge)
        here = at[edge]
        here = here[~cut[here]]
    used = np.concatenate(used) if used else np.zeros(0, np.int64)
    used = used[np.argsort(at[used], kind="stable")]
    counts = np.where(ids[used] >= 0, 1, end[used] - at[used])
    spread = _flat(at[used], counts)
    out = np.where(np.repeat(ids[used] >= 0, counts), np.repeat(ids[used], counts), pieces.byte_ids[data[spread]])
    return out.astype(np.int32), np.searchsorted(spread, limits)


class Memo:
    """Chunks segmented before, by hash; emptied when it holds ``most`` of them, which costs time and no result."""

    def __init__(self, most: int = 1 << 20):
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.hashes, self.starts, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)

    def missing(self, hashes: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.hashes, hashes)
        return np.flatnonzero((at == len(self.hashes)) | (np.append(self.hashes, 0)[at] != hashes))

    def add(self, hashes: np.ndarray, ids: np.ndarray, offsets: np.ndarray) -> None:
        """``hashes`` in ascending order, none of them known."""
        at = np.searchsorted(self.hashes, hashes)
        self.starts = np.insert(self.starts, at, len(self.ids) + offsets[:-1])
        self.counts = np.insert(self.counts, at, np.diff(offsets))
        self.hashes = np.insert(self.hashes, at, hashes)
        self.ids = np.concatenate((self.ids, ids))

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.hashes, hashes)
        return self.starts[at], self.counts[at]


def encode_block(block: Block, pieces: Pieces, memo: Memo | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Flat piece ids and offsets by text."""
    memo = Memo() if memo is None else memo
    filled = block.offsets[:-1] < block.offsets[1:]
    data = np.insert(block.data, block.offsets[:-1][filled], 32)
    offsets = np.concatenate(([0], np.cumsum(np.diff(block.offsets) + filled)))
    padded = Block(data, offsets, 0)
    if not len(data):
        return np.zeros(0, np.int32), offsets
    space, odd = data == 32, ~pieces.inner[data] & LEADING[data] & (data < 128)
    first = space.copy()
    first[1:] &= ~space[:-1]
    first |= odd
    first[1:] |= odd[:-1]
    first[offsets[:-1][filled]] = True
    limits = np.append(np.flatnonzero(first), len(data))
    hashed = padded.hashes(limits[:-1], limits[1:])
    distinct, example, which = np.unique(hashed, return_index=True, return_inverse=True)
    if len(memo.hashes) > memo.most:
        memo.clear()
    new = memo.missing(distinct)
    example = example[new]
    lengths = np.diff(limits)[example]
    chunks = data[_flat(limits[example], lengths)]
    memo.add(distinct[new], *segment(chunks, np.concatenate(([0], np.cumsum(lengths))), pieces))
    starts, counts = (x[which] for x in memo.find(distinct))
    sums = np.concatenate(([0], np.cumsum(counts)))
    return memo.ids[_flat(starts, counts)], sums[np.searchsorted(limits, offsets)]


def decode_block(ids: np.ndarray, offsets: np.ndarray, pieces: Pieces) -> list[bytes]:
    """Bytes of each id sequence: pieces joined, markers as spaces, without the space in front."""
    counts = np.diff(pieces.offsets)[ids]
    data = pieces.data[_flat(pieces.offsets[ids], counts)].tobytes()
    ends = np.concatenate(([0], np.cumsum(counts)))[offsets]
    return [data[a + data.startswith(b" ", a, b): b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


def _lists(ids: np.ndarray, offsets: np.ndarray, nulls: np.ndarray) -> pa.ListArray:
    marks = pa.array(np.append(offsets, 0)[:-1].astype(np.int32), mask=np.append(nulls, False)) if nulls.any() else offsets.astype(np.int32)
    return pa.ListArray.from_arrays(marks, ids)


def _nulls(column: pa.Array) -> np.ndarray:
    return column.is_null().to_numpy(zero_copy_only=False)


def _append(docs: DataFrame, names: dict[str, T.DataType]) -> T.StructType:
    if taken := set(names) & set(docs.columns):
        raise ValueError(f"columns {sorted(taken)} exist already; pass other names")
    return T.StructType([*docs.schema.fields, *(T.StructField(k, v) for k, v in names.items())])


def encode(docs: DataFrame, path: str, scores: str = "rank", text: str = "text", ids: str = "piece_ids") -> DataFrame:
    """``docs`` with the piece ids of its text as a new column ``ids``."""
    shared, at = docs.sparkSession.sparkContext.broadcast(vars(load(path, scores))), docs.columns.index(text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, pieces = Memo(), Pieces(**shared.value)
        for batch in batches:
            for block in blocks(batch.column(at), BLOCK):
                part = batch.slice(block.first, block.n)
                found = _lists(*encode_block(block, pieces, memo), _nulls(part.column(at)))
                yield pa.RecordBatch.from_arrays([*part.columns, found], [*batch.schema.names, ids])

    return docs.mapInArrow(run, _append(docs, {ids: T.ArrayType(T.IntegerType())}))


def decode(docs: DataFrame, path: str, ids: str = "piece_ids", text: str = "decoded") -> DataFrame:
    """``docs`` with the text of its piece ids as a new column; bytes that are no UTF-8 become U+FFFD."""
    shared, at = docs.sparkSession.sparkContext.broadcast(vars(load(path))), docs.columns.index(ids)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(**shared.value)
        for batch in batches:
            column = batch.column(at)
            column = column.fill_null([]) if column.null_count == 0 else pa.array([x or [] for x in column.to_pylist()], column.type)
            offsets = column.offsets.to_numpy().astype(np.int64)
            flat = column.values.to_numpy(zero_copy_only=False)[offsets[0]: offsets[-1]].astype(np.int64)
            found = [x.decode("utf-8", "replace") for x in decode_block(flat, offsets - offsets[0], pieces)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string(), mask=_nulls(batch.column(at)))],
                                             [*batch.schema.names, text])

    return docs.mapInArrow(run, _append(docs, {text: T.StringType()}))


def recode(docs: DataFrame, path: str, scores: str = "rank", text: str = "text", ids: str = "piece_ids") -> DataFrame:
    """``encode`` and ``decode`` in one pass: ``docs`` with the text that its piece ids decode to in the place of its
    text, and the ids as a new column. One Python worker a task holds the pieces, and rows cross over to it once."""
    shared, at = docs.sparkSession.sparkContext.broadcast(vars(load(path, scores))), docs.columns.index(text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, pieces = Memo(), Pieces(**shared.value)
        for batch in batches:
            for block in blocks(batch.column(at), BLOCK):
                part = batch.slice(block.first, block.n)
                nulls = _nulls(part.column(at))
                found, offsets = encode_block(block, pieces, memo)
                back = [x.decode("utf-8", "replace") for x in decode_block(found.astype(np.int64), offsets, pieces)]
                columns = [pa.array(back, pa.string(), mask=nulls) if i == at else c for i, c in enumerate(part.columns)]
                yield pa.RecordBatch.from_arrays([*columns, _lists(found, offsets, nulls)], [*batch.schema.names, ids])

    return docs.mapInArrow(run, _append(docs, {ids: T.ArrayType(T.IntegerType())}))


def round_trip(docs: DataFrame, path: str, scores: str = "rank") -> DataFrame:
    """``doc_id``, piece ids, and what decoding them gives: its SHA-256 and whether it is the text; both ways in one pass."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(load(path, scores)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, pieces = Memo(), Pieces(**shared.value)
        for batch in batches:
            for block in blocks(batch.column(1), BLOCK):
                part = batch.slice(block.first, block.n)
                nulls = _nulls(part.column(1))
                ids, offsets = encode_block(block, pieces, memo)
                back, data, at = decode_block(ids.astype(np.int64), offsets, pieces), block.data.tobytes(), block.offsets.tolist()
                is_byte = np.zeros(len(pieces.offsets), bool)
                is_byte[pieces.byte_ids] = True
                sums = np.concatenate(([0], np.cumsum(is_byte[ids])))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(offsets)), pa.array(sums[offsets[1:]] - sums[offsets[:-1]]),
                     _lists(ids, offsets, nulls), pa.array([hashlib.sha256(x).hexdigest() for x in back], mask=nulls),
                     pa.array([x == data[a:b] for x, a, b in zip(back, at[:-1], at[1:])])],
                    ["doc_id", "n_pieces", "n_byte_pieces", "piece_ids", "decoded_sha256", "exact"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_pieces long, n_byte_pieces long, piece_ids array<int>, decoded_sha256 string, exact boolean")

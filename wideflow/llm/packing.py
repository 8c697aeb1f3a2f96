"""Packing of documents into sequences of a fixed length by best-fit decreasing.

Each task packs what it scans, in blocks, so no text or token is shuffled. Documents
are tokenized and closed with an end id. Overlong ones are first cut into full
windows; the rests, longest first, go to the open window with the least remaining
capacity that still holds them. A segment tree over capacities (0 .. window) finds
that window. Windows that stay short are cut at powers of two, which need no padding.

Defined cases: a null or empty text is the end id alone; a null id and repeated rows
are packed like any other row; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import find_package, text_slices
from .pretokens import IdEncoder, id_bytes

#: Ids and documents that a task holds before it packs them.
BLOCK_TOKENS, BLOCK_DOCS = 4_000_000, 50_000


class CapacityTree:
    """How many open windows have each remaining capacity; the least that holds a need, in O(log n)."""

    def __init__(self, window: int):
        self.leaves = 1
        while self.leaves <= window:
            self.leaves *= 2
        self.open = [0] * (2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(window + 1)]

    def _change(self, capacity: int, by: int) -> None:
        i = capacity + self.leaves
        while i:
            self.open[i] += by
            i //= 2

    def put(self, capacity: int, window: int) -> None:
        self.windows[capacity].append(window)
        self._change(capacity, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """Removes and returns (capacity, window) with the least capacity >= need."""
        i = need + self.leaves
        while not self.open[i]:
            while i % 2 == 1:  # a right child: go up to a left one
                i //= 2
            if i == 0:
                return None
            i += 1  # its right sibling
        while i < self.leaves:
            i = 2 * i if self.open[2 * i] else 2 * i + 1
        capacity = i - self.leaves
        self._change(capacity, -1)
        return capacity, self.windows[capacity].pop()


def best_fit_decreasing(lengths: list[int], window: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of (document index, start, length); every id of every document in one piece."""
    full, rest = [], []
    for d, n in enumerate(lengths):
        whole = n // window * window
        full += [[(d, s, window)] for s in range(0, whole, window)]
        if n > whole:
            rest.append((d, whole, n - whole))
    rest.sort(key=lambda p: -p[2])  # stable: ties keep the documents' order
    tree, packed = CapacityTree(window), []
    for piece in rest:
        got = tree.take(piece[2])
        if got is None:
            packed.append([piece])
            got = window, len(packed) - 1
        else:
            packed[got[1]].append(piece)
        if got[0] > piece[2]:
            tree.put(got[0] - piece[2], got[1])
    return full + packed


def cut_short(sequence: list[tuple[int, int, int]], window: int, max_padding: int) -> list[list[tuple[int, int, int]]]:
    """A sequence that needs more padding than that, as sequences of powers of two."""
    n = sum(p[2] for p in sequence)
    if window - n <= max_padding:
        return [sequence]
    out = []
    pieces = list(reversed(sequence))
    while n:
        size = 1 << (n.bit_length() - 1)
        n, room, now = n - size, size, []
        while room:
            d, s, k = pieces.pop()
            now.append((d, s, min(k, room)))
            if k > room:
                pieces.append((d, s + room, k - room))
            room -= min(k, room)
        out.append(now)
    return out


_ENCODERS: dict[str, IdEncoder] = {}


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text: str = "text", window: int = 1024,
         end_id: int = 0, max_padding: int = 32) -> DataFrame:
    """One row per piece: ``(id_col, start, length, ids, doc_tokens, sequence_id, offset)``.

    ``ids`` holds the piece's token ids as little-endian unsigned 32-bit integers,
    ``doc_tokens`` counts the document's ids with the end id, ``sequence_id`` is unique
    over all tasks and ``offset`` is the piece's place in its sequence. A sequence is
    to be padded to ``window`` unless its length is a power of two; at most
    ``max_padding`` ids of padding are needed in any.
    """
    find_package(docs)
    end = id_bytes([end_id])

    def block(ids: list, buffers: list[bytes], numbers: list[int], kind: pa.DataType) -> pa.RecordBatch:
        lengths = [len(b) // 4 for b in buffers]
        rows = []
        for plan in best_fit_decreasing(lengths, window):
            for sequence in cut_short(plan, window, max_padding):
                at = 0
                for d, s, k in sequence:
                    rows.append((ids[d], s, k, buffers[d][4 * s:4 * (s + k)], lengths[d], numbers[0], at))
                    at += k
                numbers[0] += 1
        columns = list(zip(*rows, strict=True))
        kinds = [kind, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        return [pa.RecordBatch.from_arrays([pa.array(c[i:i + 20_000], k) for c, k in zip(columns, kinds, strict=True)],
                                           names=["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])
                for i in range(0, len(rows), 20_000)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer_path not in _ENCODERS:
            _ENCODERS[tokenizer_path] = IdEncoder(tokenizer_path)
        encode = _ENCODERS[tokenizer_path]
        numbers = [TaskContext.get().partitionId() << 36]
        ids: list = []
        buffers: list[bytes] = []
        held, kind = 0, pa.int64()
        for b in batches:
            kind = b.column(0).type
            keys, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for i, j in text_slices(texts):
                got = [encode(t) + end for t in texts[i:j]]
                ids += keys[i:j]
                buffers += got
                held += sum(map(len, got)) // 4
                if held >= BLOCK_TOKENS or len(ids) >= BLOCK_DOCS:
                    yield from block(ids, buffers, numbers, kind)
                    ids, buffers, held = [], [], 0
        if ids:
            yield from block(ids, buffers, numbers, kind)

    got = docs.select(F.col(id_col).alias("id"), F.col(text).alias("t"))
    id_kind = got.schema["id"].dataType.simpleString()
    return got.mapInArrow(run, f"id {id_kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, "
                               "offset long").withColumnRenamed("id", id_col)

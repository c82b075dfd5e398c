"""Best-fit-decreasing packing of token sequences, with a segment tree over remaining capacities.

Overlong documents are first cut into full windows; what is left of each, longest first, goes to the open window with
the least room that still holds it, which the tree finds in log2(window) steps.  A task packs a pool of bounded size at
a time, so no row moves between tasks.  Where documents may be cut, what doesn't fill a window goes on to the next pool;
else a pool's open windows are given out with padding.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokenize import loaded
from .words import sliced

MODEL = "byte_bpe_50k.json"
WINDOW = 2048
EOS = 1
#: Ids packed together: 16 MB.
POOL = 4 << 20


class Capacities:
    """Open windows by remaining capacity, 0 to size: a segment tree of counts with a stack of windows at each leaf."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.stack: list[list[int]] = [[] for _ in range(size + 1)]

    def _add(self, capacity: int, by: int) -> None:
        at = capacity + self.leaves
        while at:
            self.count[at] += by
            at >>= 1

    def put(self, capacity: int, window: int) -> None:
        self.stack[capacity].append(window)
        self._add(capacity, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """Remove and give (capacity, window) of the tightest window with room for ``least``."""
        at, count = least + self.leaves, self.count
        if not count[at]:
            while at > 1 and (at & 1 or not count[at + 1]):  # up until a right sibling has a window
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if count[2 * at] else 2 * at + 1
        capacity = at - self.leaves
        self._add(capacity, -1)
        return capacity, self.stack[capacity].pop()


#: A piece: document, start in it, length.
Piece = tuple[int, int, int]


def best_fit(pieces: list[Piece], window: int) -> tuple[list[list[Piece]], list[list[Piece]]]:
    """Full windows, and open ones."""
    full: list[list[Piece]] = []
    rest: list[Piece] = []
    for d, s, n in pieces:
        while n >= window:
            full.append([(d, s, window)])
            s, n = s + window, n - window
        if n:
            rest.append((d, s, n))
    rest.sort(key=lambda p: (-p[2], p[0], p[1]))
    tree, open_ = Capacities(window), []
    for p in rest:
        found = tree.take(p[2])
        if found is None:
            found = window, len(open_)
            open_.append([])
        room, w = found
        open_[w].append(p)
        if room > p[2]:
            tree.put(room - p[2], w)
    done = [sum(p[2] for p in w) == window for w in open_]
    return full + [w for w, x in zip(open_, done, strict=True) if x], [w for w, x in zip(open_, done, strict=True) if not x]


def topped(open_: list[list[Piece]], window: int) -> tuple[list[list[Piece]], list[Piece]]:
    """Fill the gaps of open windows, fullest first, with pieces cut from the emptiest: full windows and what is left."""
    rooms = sorted(([window - sum(p[2] for p in w), i] for i, w in enumerate(open_)))
    low, high = 0, len(rooms) - 1
    full = []
    while low < high:
        room, w = rooms[low]
        donor = open_[rooms[high][1]]
        while room and donor:
            d, s, n = donor.pop()
            if n > room:
                donor.append((d, s + room, n - room))
                n = room
            open_[w].append((d, s, n))
            room -= n
        rooms[low][0] = room
        if not room:
            full.append(open_[w])
            low += 1
        if not donor:
            high -= 1
    left = open_[rooms[low][1]] if low == high and low < len(rooms) else []
    if left and sum(p[2] for p in left) == window:
        return [*full, left], []
    return full, left


def binary(left: list[Piece]) -> list[list[Piece]]:
    """What is left, cut into sequences whose lengths are powers of two, longest first: none needs padding."""
    total, out, left = sum(p[2] for p in left), [], left[::-1]
    for bit in range(total.bit_length() - 1, -1, -1):
        room = total & (1 << bit)
        seq: list[Piece] = []
        while room:
            d, s, n = left.pop()
            if n > room:
                left.append((d, s + room, n - room))
                n = room
            seq.append((d, s, n))
            room -= n
        if seq:
            out.append(seq)
    return out


class Pool:
    """Documents of a task whose ids aren't all dealt out yet."""

    def __init__(self, window: int, cut: bool):
        self.window, self.cut = window, cut
        self.rows: list[int | None] = []
        self.ids: list[bytes] = []
        self.left: list[Piece] = []
        self.size = 0
        self.next = TaskContext.get().partitionId() << 36 if TaskContext.get() else 0

    def add(self, row, ids: bytes) -> None:
        self.left.append((len(self.rows), 0, len(ids) // 4))
        self.rows.append(row)
        self.ids.append(ids)
        self.size += len(ids) // 4

    def packed(self, last: bool) -> list[tuple[int, list[Piece]]]:
        full, open_ = best_fit(self.left, self.window)
        left: list[Piece] = []
        if self.cut:
            more, left = topped(open_, self.window)
            full += more
            if last:
                full += binary(left)
                left = []
        else:
            full += open_
        out = [(self.next + i, w) for i, w in enumerate(full)]
        self.next += len(full)
        self.left, self.size = left, sum(p[2] for p in left)
        return out

    def shrink(self) -> None:
        """Keep only the documents with pieces left."""
        keep = sorted({p[0] for p in self.left})
        place = {d: i for i, d in enumerate(keep)}
        self.rows, self.ids = [self.rows[d] for d in keep], [self.ids[d] for d in keep]
        self.left = [(place[d], s, n) for d, s, n in self.left]


def _pooled(batches, tokenizer: str, window: int, cut: bool, eos: int, pool_size: int):
    """(pool, its sequences) again and again."""
    model, pool = loaded(tokenizer), Pool(window, cut)
    end = np.array([eos], "<u4").tobytes()
    for b in sliced(batches, "text", 1 << 20):
        for row, ids in zip(b.column("doc_id").to_pylist(), model.ids([t or "" for t in b.column("text").to_pylist()]), strict=True):
            pool.add(row, ids + end)
            if pool.size >= pool_size:
                yield pool, pool.packed(False)
                pool.shrink()
    yield pool, pool.packed(True)


def _pieces(*args):
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

    def run(batches):
        for pool, found in _pooled(batches, *args):
            rows = []
            for seq, pieces in found:
                at = 0
                for d, s, n in pieces:
                    rows.append((pool.rows[d], s, n, pool.ids[d][4 * s : 4 * (s + n)], len(pool.ids[d]) // 4, seq, at))
                    at += n
            for low in range(0, len(rows), 1 << 14):
                cols = list(zip(*rows[low : low + (1 << 14)], strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names)

    return run


def packed_pieces(docs: DataFrame, tokenizer: str = MODEL, window: int = WINDOW, eos: int = EOS, id_col: str = "doc_id", text_col: str = "text", pool: int = POOL) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset), a row for each piece.

    Windows that stay open take pieces cut from the emptiest ones, and what is left at a task's end is cut into powers
    of two, so no sequence is padded.  ``ids`` are little-endian unsigned 32-bit.  A null or empty text is the end id
    alone.  Ids are only carried along: each row is packed as a document, repeated and null ids too.  A sequence's id is
    the task's number and a count; sequences are the same again for the same files.  Empty input gives no rows.
    """
    thin = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return thin.mapInArrow(
        _pieces(tokenizer, window, True, eos, pool),
        "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long",
    )


def op5(docs: DataFrame) -> DataFrame:
    """The contract's digest of :func:`packed_pieces`."""
    return packed_pieces(docs).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The last stage: the packed pieces with their ids' checksums.  Cases are those of :func:`packed_pieces`."""
    return op5(docs)

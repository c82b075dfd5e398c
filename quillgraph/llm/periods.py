"""Periodic runs of words: suffix array, longest previous factors, blocks, Main's extensions, copying.

The words of a slice of texts become one string of numbers in which texts share no number, so runs never cross texts.  Its
suffix array (prefix doubling) and LCP give the longest-previous-factor array, and that the LZ blocks.  Runs that cross or
touch a block's border are found by extending matches to both sides of the border for each period that Main's theorem
leaves; runs strictly inside a block are copies of runs at the block's earlier occurrence, taken from the starts there.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import ODD, U, mix, sliced, words

#: A run has this many words at least, and this many times its period.
LEAST, TIMES = 6, 4
#: Pairs of a border and a period looked at in one go.
PAIRS = 1 << 20
#: Tells from id and number of words where each word comes from; None: as they are.
Order = Callable[[int | None, int], np.ndarray | None]
_SCHEMA = "id {0}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


class Factors:
    """Names for the factors of 2**k numbers at every place, and the suffix array, by prefix doubling."""

    def __init__(self, s: np.ndarray):
        n = len(s)
        order = np.argsort(s, kind="stable")
        at = np.arange(n)
        head = np.maximum.accumulate(np.where(np.diff(s[order], prepend=s[order[0]] - 1) != 0, at, 0))
        rank = np.empty(n, np.int64)
        rank[order] = head
        self.levels, h = [], 1
        while True:
            first = np.diff(head, prepend=-1) != 0
            # only suffixes that share their name with another are sorted on
            live = np.flatnonzero(~(first & np.append(first[1:], True)))
            if not len(live):
                break
            self.levels.append(np.append(rank, -1).astype(np.int32))
            tied = order[live]
            nxt = np.where(tied + h < n, rank[np.minimum(tied + h, n - 1)], -1) + 1
            key = head[live] * (n + 1) + nxt
            p = np.argsort(key, kind="stable")
            key = key[p]
            order[live] = tied[p]
            head[live] = np.maximum.accumulate(np.where(np.diff(key, prepend=-1) != 0, live, 0))
            rank[order[live]] = head[live]
            h *= 2
        self.order, self.n = order, n

    def ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many numbers from i and from j on agree; i != j."""
        i, j, out = i.copy(), j.copy(), np.zeros(len(i), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            step = np.where(self.levels[k][i] == self.levels[k][j], 1 << k, 0)
            i += step
            j += step
            out += step
        return out

    def behind(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many numbers up to i and up to j, both included, agree; -1 is before the first."""
        i, j, out = i.copy(), j.copy(), np.zeros(len(i), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            a, b = i - (1 << k) + 1, j - (1 << k) + 1
            ok = (a >= 0) & (b >= 0)
            step = np.where(ok & (self.levels[k][np.maximum(a, 0)] == self.levels[k][np.maximum(b, 0)]), 1 << k, 0)
            i -= step
            j -= step
            out += step
        return out


def previous_factors(f: Factors) -> tuple[list[int], list[int]]:
    """For each place the length of the longest factor that also starts earlier, and where it does (-1: nowhere)."""
    order = f.order.tolist() + [-1]
    lcp = [0, *f.ahead(f.order[:-1], f.order[1:]).tolist(), 0]
    length, source = [0] * f.n, [-1] * f.n
    places, shared = [], []  # a stack of ascending places, each with what it shares with the one below
    for place, same in zip(order, lcp, strict=True):
        while places and (place < places[-1] or same <= shared[-1]):
            top, below = places.pop(), shared.pop()
            if place < top:
                if same > below:
                    length[top], source[top] = same, place
                elif below:
                    length[top], source[top] = below, places[-1]
                same = min(same, below)
            elif below:
                length[top], source[top] = below, places[-1]
        places.append(place)
        shared.append(same)
    return length, source


def blocks(length: list[int]) -> np.ndarray:
    """Where the LZ blocks start; the last entry is the end."""
    out, i, n = [], 0, len(length)
    while i < n:
        out.append(i)
        i += length[i] or 1
    return np.array([*out, n])


def _bordering(s: np.ndarray, f: Factors, at: np.ndarray, least: int, times: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(start, end, period) of the runs that cross or touch a border of blocks."""
    n, size = len(s), np.diff(at)
    border = at[1:]
    after = np.append(size[1:], 0)
    for right, reach in ((True, after), (False, np.minimum(size + after, border))):
        ends = np.cumsum(reach)
        lo = 0
        while lo < len(border):
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + PAIRS, "right")))
            b = np.repeat(border[lo:hi], reach[lo:hi])
            p = np.arange(len(b)) - np.repeat(np.cumsum(reach[lo:hi]) - reach[lo:hi], reach[lo:hi]) + 1
            lo = hi
            x, y = (b, b + p) if right else (b - p, b)  # a period apart, the border between or before them
            near = np.append(s, -1)
            some = (near[x] == near[np.minimum(y, n)]) & (y < n) | (x > 0) & (near[x - 1] == near[y - 1])
            x, y, p = x[some], y[some], p[some]
            more, less = f.ahead(x, np.minimum(y, n)), f.behind(x - 1, y - 1)
            ok = more + less + p >= np.maximum(least, times * p)
            yield x[ok] - less[ok], y[ok] + more[ok], p[ok]


def runs_of(s: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, end, smallest period) of all maximal runs with max(least, times * period) numbers, times >= 2; end is one past the last."""
    if len(s) < max(least, times):
        return []
    f = Factors(s)
    if not f.levels:
        return []
    length, source = previous_factors(f)
    at = blocks(length)
    found: dict[tuple[int, int], int] = {}
    for start, end, period in _bordering(s, f, at, least, times):
        for a, e, p in zip(start.tolist(), end.tolist(), period.tolist(), strict=True):
            found[a, e] = min(p, found.get((a, e), p))
    ends: dict[int, list[tuple[int, int]]] = {}  # the bucket of each start
    for (a, e), p in found.items():
        ends.setdefault(a, []).append((e, p))
    starts = sorted(ends)
    if starts:
        for b, e in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            if e - b < least + 2:
                continue
            back = b - source[b]
            i = bisect_right(starts, b - back)
            # ascending, so copies made within this block are copied on where a block reaches into itself
            while i < len(starts) and starts[i] + back < e - 1:
                a = starts[i]
                for end, p in list(ends[a]):
                    if end + back < e:
                        to = ends.setdefault(a + back, [])
                        if not to:
                            insort(starts, a + back)
                        if (end + back, p) not in to:
                            to.append((end + back, p))
                i += 1
    best: dict[tuple[int, int], int] = {}
    for a, bucket in ends.items():
        for e, p in bucket:
            best[a, e] = min(p, best.get((a, e), p))
    return sorted((a, e, p) for (a, e), p in best.items())


def _frequent(ids: np.ndarray, text: np.ndarray, least: int, times: int) -> tuple[np.ndarray, np.ndarray]:
    """(s, place): the stretches that can hold runs, a number of their own between them, and the place of each number.

    Every number of a run is in it ``times`` times at least.  So places whose number is rarer in their stretch go, which
    cuts stretches, until none does; what is left is a small part of ordinary prose.
    """
    place = np.arange(len(ids))
    part = text
    while len(place):
        key = mix(ids[place].astype(U) * ODD + part.astype(U))
        _, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
        keep = count[inverse] >= times
        here = place[keep]
        part = np.cumsum(np.diff(here, prepend=-2) > 1) + np.cumsum(np.diff(part[keep], prepend=-1) != 0)
        _, inverse, count = np.unique(part, return_inverse=True, return_counts=True)
        long = count[inverse] >= max(least, times)
        here, part = here[long], part[long]
        if len(here) == len(place):
            break
        place = here
    if not len(place):
        return place, place
    cut = np.flatnonzero(np.diff(part) != 0) + 1
    _, s = np.unique(ids[place], return_inverse=True)
    return np.insert(s, cut, s.max() + 1 + np.arange(len(cut))), np.insert(place, cut, -1)


def source_order(doc_id: int | None, n: int) -> np.ndarray | None:
    """Where the words of a document come from under the contract's rewriting; None: as they are."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % p)


def periodic(texts: list[str], ids: list, order: Order | None = None, least: int = LEAST, times: int = TIMES) -> Iterator[tuple[int, list[tuple[int, int, int]], str]]:
    """(number of words, runs as (start, length, period) in order, text without repetitions) of each text."""
    w = words(texts)
    first, counts = w.first, w.counts
    orders = [order(i, int(n)) if order else None for i, n in zip(ids, counts, strict=True)]
    come = np.arange(len(w.start))
    for t, o in enumerate(orders):
        if o is not None:
            come[first[t] : first[t + 1]] = first[t] + o
    text = w.text_of()
    # texts share no number: a word's number tells its text as well
    _, numbers = np.unique(mix(w.hash ^ mix(text.astype(U) * ODD)), return_inverse=True)
    s, place = _frequent(numbers[come], text, least, times)
    of: dict[int, list[tuple[int, int, int]]] = {}
    for a, e, p in runs_of(s, least, times):
        t = int(text[place[a]])
        of.setdefault(t, []).append((int(place[a] - first[t]), e - a, p))
    for t in range(len(texts)):
        n, runs = int(counts[t]), sorted(of.get(t, []), key=lambda r: (r[0], r[2]))
        raw = [w.data[x:y] for x, y in zip(w.start[first[t] : first[t + 1]].tolist(), w.end[first[t] : first[t + 1]].tolist(), strict=True)]
        if orders[t] is not None:
            raw = [raw[i] for i in orders[t].tolist()]
        if runs:
            mark = np.zeros(n + 1, np.int64)
            for a, m, p in runs:
                mark[a + p] += 1
                mark[a + m] -= 1
            raw = [raw[i] for i in np.flatnonzero(np.cumsum(mark[:n]) == 0).tolist()]
        yield n, runs, b" ".join(raw).decode("utf-8", "surrogatepass")


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, times: int = TIMES, order: Order | None = None
) -> DataFrame:
    """(id, n_words, runs, collapsed), a row for each input row; ``runs`` are structs of start, length and period by start, then period.

    A run is a stretch of consecutive words with smallest period q and max(least, times * q) words that no neighbouring
    word extends keeping period q.  ``collapsed`` has the words that no run contains after its first q, joined by a blank.
    ``order`` may tell, from id and number of words, where each word comes from.

    A null text has no words and no runs.  Ids are only carried along: null and repeated ones keep a row each.  Other
    columns aren't read.  Empty input gives no rows.  Texts are worked on in slices of a megabyte, a longer one alone; its
    task needs about 4 bytes for each word that can be in a run and each doubling of the longest repetition.  Words are
    compared by 64-bit hashes within a slice.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches, "text"):
            ids, texts = b.column("id").to_pylist(), [t or "" for t in b.column("text").to_pylist()]
            rows = [(n, [dict(zip(("start", "length", "period"), r, strict=True)) for r in runs], text) for n, runs, text in periodic(texts, ids, order, least, times)]
            kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
            columns = [b.column("id"), pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], kind), pa.array([r[2] for r in rows], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_words", "runs", "collapsed"])

    thin = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return thin.mapInArrow(run, _SCHEMA.format(thin.schema["id"].dataType.simpleString()))


def op12(docs: DataFrame) -> DataFrame:
    """The contract's columns, over words in the contract's order."""
    found = periodic_runs(docs.withColumn("doc_id", F.col("doc_id").cast("long")), order=source_order)
    best = F.expr("array_max(transform(runs, r -> struct(r.length as length, -r.start as start, -r.period as period)))")
    listed = F.expr("array_join(transform(runs, r -> concat_ws(',', r.start, r.length, r.period)), '\n')")
    found = found.select("id", "runs", "collapsed", best.alias("best"), F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("").alias("listed"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2("listed", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )

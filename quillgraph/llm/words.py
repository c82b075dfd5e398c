"""Words of a batch of texts as numpy arrays: where they are and a 64-bit hash of each.

A word is a run of bytes other than blank and \\t to \\r, as ``bytes.split()`` cuts them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
MAX = U(0xFFFFFFFFFFFFFFFF)
ODD = U(0x9E3779B97F4A7C15)
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
_MASK = np.array([(1 << (8 * k)) - 1 for k in range(9)], U)
#: Longer words are hashed one by one.
LONG = 256
#: Bytes of text worked on at once.
BATCH = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


@dataclass
class Words:
    data: bytes
    start: np.ndarray  # first byte of each word
    end: np.ndarray  # one past its last
    first: np.ndarray  # index of each text's first word; one more entry than texts
    hash: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """Index of the text that each word is in."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def hashes(data: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each data[start:end], eight bytes at a time."""
    padded = np.frombuffer(data + b"\0" * 8, np.uint8)
    eight = np.lib.stride_tricks.as_strided(padded[:8].view("<u8"), (len(data) + 1,), (1,), writeable=False)
    length = end - start
    h = mix(eight[start] & _MASK[np.minimum(length, 8)] ^ (length.astype(U) * ODD))
    rest = np.flatnonzero((length > 8) & (length <= LONG))
    k = 8
    while len(rest):
        h[rest] = mix(h[rest] * ODD + (eight[start[rest] + k] & _MASK[np.minimum(length[rest] - k, 8)]))
        k += 8
        rest = rest[length[rest] > k]
    for i in np.flatnonzero(length > LONG):
        h[i] = U(int.from_bytes(blake2b(data[start[i] : end[i]], digest_size=8).digest(), "little"))
    return h


def words(texts: list[str], lower: bool = False) -> Words:
    """``lower`` folds A-Z only."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    at = np.cumsum([0] + [len(t) + 1 for t in raw])
    data = b"\n".join(raw) + b"\n"
    if lower:
        data = data.lower()
    edge = np.flatnonzero(np.diff(SPACES[np.frombuffer(data, np.uint8)].view(np.int8), prepend=np.int8(1)))
    start, end = edge[::2], edge[1::2]
    return Words(data, start, end, np.searchsorted(start, at), hashes(data, start, end))


def grams(h: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """A hash of every k consecutive words, by doubling; len(h) - k + 1 of them, text ends not minded."""
    if len(h) < k:
        return np.zeros(0, U)
    h = mix(h ^ U(seed)) if seed else h
    powers, have = {1: h}, 1
    while have * 2 <= k:
        p = powers[have]
        powers[have * 2] = mix(p[:-have] * ODD + p[have:]) if len(p) > have else np.zeros(0, U)
        have *= 2
    out, used = powers[have], have
    while used < k:
        step = 1 << ((k - used).bit_length() - 1)
        n = len(h) - used - step + 1
        out = mix(out[:n] * ODD + powers[step][used : used + n])
        used += step
    return out


def sliding(x: np.ndarray, w: int, f=np.minimum) -> np.ndarray:
    """f over every w neighbours; len(x) - w + 1 values."""
    if len(x) < w:
        return x[:0]
    have = 1
    while have * 2 <= w:
        x = f(x[:-have], x[have:])
        have *= 2
    return f(x[: len(x) - (w - have)], x[w - have :]) if have < w else x


def within(w: Words, k: int) -> np.ndarray:
    """Which runs of k words lie within one text."""
    n = max(0, len(w.start) - k + 1)
    t = w.text_of()
    return t[:n] == t[k - 1 : k - 1 + n]


def sliced(batches: Iterable[pa.RecordBatch], column: str, size: int = BATCH) -> Iterator[pa.RecordBatch]:
    """The batches cut to about ``size`` bytes of ``column`` each; a longer text is alone in its slice."""
    for b in batches:
        if not b.num_rows:
            continue
        lens = pc.fill_null(pc.binary_length(b.column(column)), 0)
        cut, total = 0, 0
        for i, n in enumerate(lens.to_pylist()):
            if total and total + n > size:
                yield b.slice(cut, i - cut)
                cut, total = i, 0
            total += n
        yield b.slice(cut)

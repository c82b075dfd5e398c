"""Public tokenizers behind one small interface, with a bounded cache of what each short chunk encodes to.

Both kinds of tokenizer used here treat a text as a row of chunks that never influence each other, so a chunk met again
need not be encoded again.  For byte-level BPE with the usual pattern, a chunk is a run of non-space with one blank
before it, or a run of white space as the pattern cuts it; no pre-token crosses these.  For a piece model whose
normaliser is the identity, no piece has a blank after another character, so merges stop at blanks.  Both conditions
are looked up in the model; where they don't hold, and for texts with an added token's string, the whole text goes to
the library.  All ids come from the library.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from functools import lru_cache

import numpy as np

from .words import SPACES as _SPACES
from .words import hashes, words

#: Chunks in a cache, and the longest chunk kept there.
CACHE, LONGEST = 1_000_000, 48
#: White space by Unicode's property of that name, besides ASCII's.
_WIDE = re.compile("[\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]")
_MARK = "▁"
_RUN = re.compile(f"{_MARK}+[^{_MARK}]*")


def located(name: str) -> str:
    """name if it is a file here, else the file of that name among the public tokenizers installed here."""
    if os.path.exists(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def version(name: str) -> str:
    """A digest of the tokenizer's file and of the library that reads it."""
    path = located(name)
    if path.endswith(".model"):
        import sentencepiece as library
    else:
        import tokenizers as library
    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + library.__version__.encode()).hexdigest()


class Pieces:
    """A sentencepiece model: counts only."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(len(self.model))]
        probe = f" a  b{_MARK}c\tÅﬁ　 "
        same = self.model.normalize(probe) == _MARK + probe.replace(" ", _MARK)
        plain = [p for i, p in enumerate(pieces) if not (self.model.is_control(i) or self.model.is_unused(i))]
        self.apart = same and not any(re.search(f"[^{_MARK}]{_MARK}", p) for p in plain)
        # a blank at the end is a chunk alone; by itself the library takes it for no text
        self.known: dict[str, int] = {"": len(self.model.encode("a ")) - len(self.model.encode("a"))}

    def _whole(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.model.encode(texts, num_threads=1)] if texts else []

    def counts(self, texts: list[str]) -> list[int]:
        if not self.apart:
            return self._whole(texts)
        cut = []
        for t in texts:
            t = t.replace(_MARK, " ")
            parts = t.split(" ")
            # an empty part means a run of blanks, which is one chunk with what follows it
            cut.append(([x[1:] for x in _RUN.findall(_MARK + t.replace(" ", _MARK))] if "" in parts else parts) if t else [])
        if len(self.known) > CACHE:
            self.known = {"": self.known[""]}
        known = self.known
        new = list(set().union(*cut).difference(known))
        fresh = dict(zip(new, self._whole(new), strict=True))
        known.update((k, n) for k, n in fresh.items() if len(k) <= LONGEST)
        if len(known) >= len(fresh) and all(len(k) <= LONGEST for k in fresh):
            get = known.__getitem__
        else:
            get = lambda k: known[k] if k in known else fresh[k]
        return [sum(map(get, parts)) for parts in cut]


class Bytes:
    """A tokenizers file: ids as little-endian bytes, four for each id.

    Chunks are found and looked up as arrays: a chunk is a word, with the blank before it if there is one, or the white
    space left between words.  A chunk's key is a 64-bit hash of its bytes and its place.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.apart = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not spec.get("normalizer")
        self.added = [x["content"] for x in spec.get("added_tokens", [])]
        self.line = self._whole(["\n"])[0]
        self._clear()

    def _clear(self) -> None:
        self.key, self.at, self.size, self.flat, self.used = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1 << 16, "<u4"), 0

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(x.ids, "<u4").tobytes() for x in self.model.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

    def _encoded(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of chunks without a line end, one after another, and how many each has.

        Many go to the library as one text, a line each; no token joins a line end and a word.
        """
        flat, sizes, line = [], [], np.frombuffer(self.line, "<u4")[0]
        for low in range(0, len(chunks), 512):
            part = chunks[low : low + 512]
            ids = np.frombuffer(self._whole(["\n".join(part)])[0], "<u4")
            ends = np.flatnonzero(ids == line)
            if len(ends) != len(part) - 1:
                each = [np.frombuffer(x, "<u4") for x in self._whole(part)]
                flat += each
                sizes.append(np.array([len(x) for x in each]))
            else:
                flat.append(ids[ids != line])
                sizes.append(np.diff(ends, prepend=-1, append=len(ids)) - 1)
        return np.concatenate(flat), np.concatenate(sizes)

    def _learn(self, key: np.ndarray, chunks: list[bytes], blank: np.ndarray) -> None:
        """Blank chunks are encoded each by itself."""
        order = np.concatenate([np.flatnonzero(~blank), np.flatnonzero(blank)])
        text = [chunks[i].decode("utf-8") for i in order.tolist()]
        n = int((~blank).sum())
        flat, size = self._encoded(text[:n]) if n else (np.zeros(0, "<u4"), np.zeros(0, np.int64))
        if n < len(text):
            spaces = [np.frombuffer(x, "<u4") for x in self._whole(text[n:])]
            flat, size = np.concatenate([flat, *spaces]), np.concatenate([size, [len(x) for x in spaces]])
        while self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(len(self.flat), "<u4")])
        self.flat[self.used : self.used + len(flat)] = flat
        at = self.used + np.cumsum(size) - size
        self.used += len(flat)
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        at, size = at[back], size[back]
        place = np.searchsorted(self.key, key)
        self.key, self.at, self.size = np.insert(self.key, place, key), np.insert(self.at, place, at), np.insert(self.size, place, size)

    def ids(self, texts: list[str]) -> list[bytes]:
        if not self.apart:
            return self._whole(texts)
        # texts with an added token's string, or with white space other than ASCII's, go to the library whole
        odd = [i for i, t in enumerate(texts) if any(a in t for a in self.added) or not t.isascii() and _WIDE.search(t)]
        if not odd:
            return self._quick(texts) if texts else []
        out: list = [None] * len(texts)
        for i, x in zip(odd, self._whole([texts[i] for i in odd]), strict=True):
            out[i] = x
        rest = sorted(set(range(len(texts))).difference(odd))
        for i, x in zip(rest, self._quick([texts[i] for i in rest]) if rest else [], strict=True):
            out[i] = x
        return out

    def _quick(self, texts: list[str]) -> list[bytes]:
        w = words(texts)
        raw = np.frombuffer(w.data, np.uint8)
        n_docs, n = len(texts), len(w.start)
        lens = np.array([len(t.encode("utf-8")) for t in texts])
        head = np.cumsum(lens + 1) - lens - 1  # first byte of each text
        # the white space before each word, and after each text's last
        before = np.empty(n, np.int64)
        before[1:] = w.end[:-1]
        opens = w.first[:-1][w.counts > 0]
        before[opens] = head[w.counts > 0]
        blank = ((w.start > before) & (raw[w.start - 1] == 32)).astype(np.int64)
        last = head.copy()
        last[w.counts > 0] = w.end[w.first[1:][w.counts > 0] - 1]
        # items in order: for each word the gap without the blank that the word takes, but for its last character if that is
        # no blank; that character; the word; and the text's tail
        gap = w.start - blank - before
        one = ((blank == 0) & (gap > 1)).astype(np.int64)
        start = np.stack([before, w.start - one, w.start - blank], 1).reshape(-1)
        end = np.stack([w.start - blank - one, w.start, w.end], 1).reshape(-1)
        end[1::3] = np.where(one == 1, w.start, start[1::3])
        tails = 3 * w.first[1:]
        start, end = np.insert(start, tails, last), np.insert(end, tails, head + lens)
        doc = np.insert(np.repeat(w.text_of(), 3), tails, np.arange(n_docs))
        some = end > start
        start, end, doc = start[some], end[some], doc[some]
        key, lead, which = np.unique(hashes(w.data, start, end), return_index=True, return_inverse=True)
        if len(self.key) > CACHE:
            self._clear()
        place = np.searchsorted(self.key, key)
        new = np.ones(len(key), bool)
        inside = place < len(self.key)
        new[inside] = self.key[place[inside]] != key[inside]
        if new.any():
            a, b = start[lead[new]], end[lead[new]]
            self._learn(key[new], [w.data[x:y] for x, y in zip(a.tolist(), b.tolist(), strict=True)], _SPACES[raw[b - 1]])
            place = np.searchsorted(self.key, key)
        place = place[which]
        size = self.size[place]
        ends = np.cumsum(size)
        out = self.flat[np.repeat(self.at[place] - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]
        cut = np.concatenate([[0], ends])[np.searchsorted(doc, np.arange(n_docs + 1))]
        return [out[a:b].tobytes() for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]

    def counts(self, texts: list[str]) -> list[int]:
        return [len(x) // 4 for x in self.ids(texts)]


@lru_cache(8)
def loaded(name: str) -> Pieces | Bytes:
    path = located(name)
    return Pieces(path) if path.endswith(".model") else Bytes(path)

"""Substring dedup by repeated-phrase automata.

A phrase is ``window`` consecutive words of one document.  A phrase that also starts earlier (smaller id, or the same
document and an earlier start) is a repeat, and every word that a repeat covers goes.

1. Anchors.  Among the ANCHOR-word grams of a phrase the one with the least hash is its anchor, so equal phrases have
   equal anchors.  Anchors are counted over the corpus (partial sums, then one small row each) and their places joined
   to those seen twice or more; all else can't repeat.
2. Confirmation.  Documents are dealt into buckets of bounded bytes.  A bucket hashes the phrases around its surviving
   anchors and sends one row for each different phrase, however often it holds it.  Over these rows a phrase's first
   place and its number of places follow; what occurs once goes.  Rows of phrases with a hot anchor, which very many
   buckets may hold, are dealt to SALTS tasks first and their results merged.
3. Automata.  Each bucket gets, for each recurring phrase that it holds, one place to read it from.  It compiles them
   into Aho-Corasick automata (PHRASES phrases at most in each, words as letters of a small alphabet), streams all its
   documents through each and compares the words of every hit, which finds every occurrence.

No step gathers a hot key's rows in one task; work and shuffle follow the text.
"""

from __future__ import annotations

from itertools import islice

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import HOT, NULL_ID, SALTS, bucket_of, buckets, discard, keyed, some, spread_join, text_bytes, written
from .words import MAX, grams, sliced, sliding, within, words

ANCHOR = 8
#: Bytes of text in a bucket, and phrases in an automaton: some 20 nodes of 50 bytes each.
BUCKET = 2 << 20
PHRASES = 50_000
#: One document in so many is looked at for hot anchors, which have at least LEAST places there.
PROBE, LEAST = 16, 200
#: Hits of an automaton looked at together.
HITS = 1 << 16


def _anchors(texts: list[str], window: int):
    """The words, each gram's hash (MAX where it crosses texts), each phrase's least gram and which phrases exist."""
    w = words(texts)
    k = min(ANCHOR, window)
    g = grams(w.hash, k)
    g = np.where(within(w, k), np.minimum(g, MAX - np.uint64(1)), MAX)
    real = within(w, window)
    return w, g, sliding(g, window - k + 1), real, k


def _selected(g: np.ndarray, least: np.ndarray, real: np.ndarray, span: int) -> np.ndarray:
    """Places of grams that are the anchor of some phrase."""
    if not real.any():
        return np.zeros(0, np.int64)
    low = np.where(real, least, np.uint64(0))
    edge = np.zeros(span - 1, np.uint64)
    top = sliding(np.concatenate([edge, low, edge]), span, np.maximum)
    return np.flatnonzero((top == g) & (top > 0))


def _places(window: int):
    def run(batches):
        for b in sliced(batches, "text"):
            w, g, least, real, k = _anchors(b.column("text").to_pylist(), window)
            at = _selected(g, least, real, window - k + 1)
            t = np.searchsorted(w.first, at, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(g[at].view(np.int64)),
                    pa.array(b.column("did").to_numpy(False)[t]),
                    pa.array(b.column("ver").to_numpy(False)[t]),
                    pa.array((at - w.first[t]).astype(np.int32)),
                ],
                ["fp", "did", "ver", "at"],
            )

    return run


def _counts(window: int):
    def run(batches):
        for b in sliced(batches, "text"):
            _, g, least, real, k = _anchors(b.column("text").to_pylist(), window)
            fp, n = np.unique(g[_selected(g, least, real, window - k + 1)], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(fp.view(np.int64)), pa.array(n)], ["fp", "n"])

    return run


class _Bucket:
    """The documents of a bucket, one for each (did, ver), and how to find them."""

    def __init__(self, docs: pa.Table):
        did, ver = docs.column("did").to_numpy(), docs.column("ver").to_numpy()
        self.order = np.lexsort((ver, did))
        did, ver = did[self.order], ver[self.order]
        new = np.ones(len(did), bool)
        new[1:] = (did[1:] != did[:-1]) | (ver[1:] != ver[:-1])
        self.doc = np.cumsum(new) - 1  # of each row, in order
        self.did, self.ver = did[new], ver[new]
        texts = docs.column("text")
        self.texts = [texts[int(i)].as_py() for i in self.order[new]]

    def find(self, did: np.ndarray, ver: np.ndarray) -> np.ndarray:
        i = np.searchsorted(self.did, did)
        if (self.ver == 0).all():
            return i
        place = {k: j for j, k in enumerate(zip(self.did.tolist(), self.ver.tolist(), strict=True))}
        return np.array([place[k] for k in zip(did.tolist(), ver.tolist(), strict=True)], np.int64)


def _phrases(window: int):
    """One row for each different phrase of a bucket whose anchor survives: its hash, its first place there, and ``p``:
    24 more bits of hash, whether the bucket holds it more than once, a salt, and the place's word, in one number.  The
    salt is 0 unless the phrase's anchor is hot; the hash is changed by it."""
    names = ["h", "p", "did", "ver"]

    def run(docs: pa.Table, places: pa.Table) -> pa.Table:
        if not docs.num_rows or not places.num_rows:
            return pa.table([pa.array([], pa.int64())] * 4, names)
        bucket = _Bucket(docs)
        w, g, least, real, k = _anchors(bucket.texts, window)
        kept = np.full(len(g), MAX)
        at = w.first[bucket.find(places.column("did").to_numpy(), places.column("ver").to_numpy())] + places.column("at").to_numpy()
        kept[at] = g[at]
        hot = np.unique(g[at[places.column("hot").to_numpy()]])
        i = np.flatnonzero(real & (sliding(kept, window - k + 1) == least))
        h, check = grams(w.hash, window)[i], grams(w.hash, window, 77)[i] >> np.uint64(40)
        order = np.lexsort((i, check, h))
        h, check, i = h[order], check[order], i[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (check[1:] != check[:-1])
        lead = np.flatnonzero(new)
        many = np.diff(np.append(lead, len(h))) > 1
        # back in the order of the text, in which ids and places compress well
        back = np.argsort(i[lead], kind="stable")
        lead, many = lead[back], many[back]
        t = np.searchsorted(w.first, i[lead], "right") - 1
        own = docs.column("b")[0].as_py() % SALTS + 1
        salt = np.where(np.isin(least[i[lead]], hot), own, 0) if len(hot) else np.zeros(len(lead), np.int64)
        p = (check[lead].astype(np.int64) << 40) | (many.astype(np.int64) << 39) | (salt << 31) | (i[lead] - w.first[t])
        return pa.table([pa.array(c) for c in (h[lead].view(np.int64) ^ salt, p, bucket.did[t], bucket.ver[t])], names)

    return run


#: Letters of the automata's alphabet: few, as a node's edges are searched one by one.
LETTERS = 64


def _located(bucket: _Bucket, routes: pa.Table, window: int):
    """For each document a mask of the words that repeats cover.

    A word is a letter by its hash; where an automaton finds a phrase's letters, 128 bits of hash of the words there are
    compared with those of the phrase.
    """
    w = words(bucket.texts)
    line = np.full(len(w.start) + len(bucket.texts), ord("~"), np.uint8)  # a mark after each text, no letter
    line[np.arange(len(w.start)) + w.text_of()] = (w.hash % np.uint64(LETTERS)).astype(np.uint8) + 48
    text, one, two = line.tobytes().decode("ascii"), grams(w.hash, window), grams(w.hash, window, 77)
    marks = w.first[:-1] + np.arange(len(bucket.texts))  # where each text begins in the line
    doc = bucket.find(routes.column("did").to_numpy(), routes.column("ver").to_numpy())
    at = routes.column("at").to_numpy()
    begins, places, leads = marks[doc] + at, w.first[doc] + at, routes.column("lead").to_numpy(False)
    cover = np.zeros(len(w.start) + 1, np.int32)
    for low in range(0, len(begins), PHRASES):
        begin, place, lead = (x[low : low + PHRASES] for x in (begins, places, leads))
        keys: dict[str, int] = {}
        key = np.array([keys.setdefault(text[s : s + window], len(keys)) for s in begin.tolist()], np.int64)
        auto = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for letters, n in keys.items():
            auto.add_word(letters, n)
        auto.make_automaton()
        # the phrases of each key: one, but where words share letters
        phrases = np.argsort(key, kind="stable")
        first = np.searchsorted(key[phrases], np.arange(len(keys) + 1))
        found = auto.iter(text)
        while hits := list(islice(found, HITS)):
            e, k = np.array(hits, np.int64).T
            n = first[k + 1] - first[k]
            phrase = phrases[np.repeat(first[k] - np.cumsum(n) + n, n) + np.arange(n.sum())]
            e = np.repeat(e, n)
            end = e - np.searchsorted(marks, e, "right") + 1
            mine, its = end - window + 1, place[phrase]
            ok = (one[mine] == one[its]) & (two[mine] == two[its]) & ~(lead[phrase] & (begin[phrase] == e - window + 1))
            np.add.at(cover, mine[ok], 1)
            np.add.at(cover, end[ok] + 1, -1)
    mask = np.cumsum(cover)[:-1] > 0
    return [mask[a:b] for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True)]


def _without(text: str, mask: np.ndarray, layout: bool) -> str:
    """A text without the masked words: the rest as it stands, white space after a word going with it; or, where
    ``layout`` isn't wanted, the other words joined by one blank."""
    raw = text.encode("utf-8", "surrogatepass")
    if not layout:
        return b" ".join(x for x, gone in zip(raw.split(), mask.tolist(), strict=True) if not gone).decode("utf-8", "surrogatepass")
    if not mask.any():
        return text
    w = words([text])
    start = np.append(w.start, len(raw))
    edge = np.flatnonzero(np.diff(mask.view(np.int8), prepend=0, append=0)).tolist()
    out, at = [], 0
    for a, b in zip(edge[::2], edge[1::2], strict=True):
        out.append(raw[at : start[a]])
        at = int(start[b])
    return b"".join([*out, raw[at:]]).decode("utf-8", "surrogatepass")


def _results(window: int, row_type: pa.DataType, text_col: str, layout: bool):
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(docs: pa.Table, routes: pa.Table) -> pa.Table:
        names = ["row", "n_words", "n_removed", "spans", "kept"]
        if not docs.num_rows:
            return pa.table([pa.array([], t) for t in (row_type, pa.int64(), pa.int64(), span, pa.string())], names)
        text = docs.column("row").combine_chunks().field(text_col).cast(pa.string()).fill_null("")
        bucket = _Bucket(docs.append_column("text", text))
        n, gone, spans, kept = [], [], [], []
        for mask, text in zip(_located(bucket, routes, window), bucket.texts, strict=True):
            n.append(len(mask))
            gone.append(int(mask.sum()))
            edge = np.flatnonzero(np.diff(mask.view(np.int8), prepend=0, append=0)).tolist()
            spans.append([{"start": a, "end": b} for a, b in zip(edge[::2], edge[1::2], strict=True)])
            kept.append(_without(text, mask, layout))
        rows = docs.column("row").take(pa.array(bucket.order)).combine_chunks()
        rows = rows.cast(row_type) if rows.type != row_type else rows
        pick = bucket.doc
        take = lambda x, t: pa.array([x[i] for i in pick], t)
        return pa.table([rows, take(n, pa.int64()), take(gone, pa.int64()), take(spans, span), take(kept, pa.string())], names)

    return run


def substring_dedup(docs: DataFrame, window: int = 20, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = BUCKET, layout: bool = True) -> DataFrame:
    """(row, n_words, n_removed, spans, kept): each input row as a struct, its words, how many go, the removed runs of
    words as [start, end), and the text without them: as it stands, or with ``layout`` off its words joined by one blank.

    Rows alike in id and text are worked on once, however many there are, and each gets the result.

    A null or empty text has no words.  Texts shorter than ``window`` words keep all.  Repeated or null ids: see
    :func:`shared.keyed`.  Any other columns travel untouched in ``row``.  Empty input gives no rows.
    """
    base = keyed(docs, id_col, text_col)
    copies = base.groupBy("did", "ver").agg(F.count("*").alias("n")).filter("n > 1")
    if copies.isEmpty():
        return _dedup(docs, base, window, text_col, bucket_bytes, layout)
    copies = written(copies, "copies")
    once = _dedup(docs, keyed(docs, id_col, text_col, alone=True), window, text_col, bucket_bytes, layout)
    text = F.coalesce(F.col("row")[text_col].cast("string"), F.lit(""))
    did = F.coalesce(F.col("row")[id_col].cast("long"), F.lit(NULL_ID))
    once = once.select(did.alias("did"), F.xxhash64(text).alias("ver"), "n_words", "n_removed", "spans", "kept")
    hot = copies.filter(F.col("n") > HOT * docs.count())
    each = base.select("row", "did", "ver", F.monotonically_increasing_id().alias("_at"))
    return spread_join(each, once, ["did", "ver"], hot, ["_at"]).select("row", "n_words", "n_removed", "spans", "kept")


def _dedup(docs: DataFrame, base: DataFrame, window: int, text_col: str, bucket_bytes: int, layout: bool) -> DataFrame:
    """The work of :func:`substring_dedup` on keyed rows, of which no two are alike in id and text."""
    from pyspark.sql.pandas.types import to_arrow_type

    n = buckets(text_bytes(docs, text_col), bucket_bytes)
    thin = base.select("did", "ver", "text")
    counted = lambda df: df.mapInArrow(_counts(window), "fp long, n long").groupBy("fp").agg(F.sum("n").alias("n")).filter("n > 1")
    # which anchors are hot only decides how rows are dealt, so one document in PROBE tells
    probe = written(counted(thin.filter(F.pmod(F.xxhash64("did", "ver"), F.lit(PROBE)) == 0)), "probe")
    # at most 1 / HOT anchors hold more than that share of the places: the bound of what is broadcast
    frequent = max(LEAST, HOT * (probe.agg(F.sum("n")).first()[0] or 0))
    hot = some(probe.filter(F.col("n") > frequent).select("fp"), "hot")
    discard(probe)
    places = thin.mapInArrow(_places(window), "fp long, did long, ver long, at int")
    anchors = counted(thin).select("fp")
    if hot is None:
        places = places.join(anchors, "fp").withColumn("hot", F.lit(False))
    else:
        # places of hot anchors stay anyway: they pass the join by a number of their own, spread over the tasks
        places = places.join(F.broadcast(hot.select(F.col("fp").alias("f"))), F.col("fp") == F.col("f"), "left").withColumn("hot", F.col("f").isNotNull())
        places = places.withColumn("key", F.when(F.col("hot"), F.xxhash64("did", "ver", "at")).otherwise(F.col("fp")))
        places = places.join(anchors.withColumnRenamed("fp", "a"), F.col("key") == F.col("a"), "left").filter("hot or a is not null")
    b = bucket_of(n, "did", "ver").alias("b")
    places = written(places.select(b, "did", "ver", "at", "hot"), "anchors")
    dealt = thin.select(b, "did", "ver", "text")
    phrases = dealt.groupBy("b").cogroup(places.groupBy("b")).applyInArrow(_phrases(window), "h long, p long, did long, ver long").repartition("h")
    bits = lambda shift, size: F.shiftright("p", shift).bitwiseAND(F.lit((1 << size) - 1))
    phrases = phrases.select("h", bits(40, 24).alias("k"), "did", "ver", bits(0, 31).cast("int").alias("at"), (bits(39, 1) == 1).alias("many"), bits(31, 8).cast("int").alias("salt"))
    same = Window.partitionBy("h", "k")
    here = F.struct("did", "ver", "at")
    routes = phrases.select("*", F.min(here).over(same).alias("lead"), F.count("*").over(same).alias("places"))
    lead = here == F.col("lead")
    once = F.when(F.col("salt") > 0, F.lit(True)).otherwise((F.col("many") | (F.col("places") > 1)) & (F.col("many") | ~lead))
    routes = routes.filter(once).select(b, "did", "ver", "at", lead.alias("lead"), "many", "salt", F.when(F.col("salt") > 0, F.col("h").bitwiseXOR(F.col("salt"))).alias("h"), F.when(F.col("salt") > 0, F.col("k")).alias("k"))
    routes = written(routes, "phrases")
    discard(places)
    cols = ["b", "did", "ver", "at", "lead"]
    cold = routes.filter("salt = 0").select(*cols)
    if hot is not None:
        salted = routes.filter("salt > 0")
        merged = salted.groupBy("h", "k").agg(F.min(here).alias("first"), F.count("*").alias("places"))
        merged = merged.withColumn("salt", F.explode(F.sequence(F.lit(1), F.lit(SALTS))))
        salted = salted.drop("lead").join(merged, ["h", "k", "salt"]).withColumn("lead", here == F.col("first"))
        cold = cold.unionAll(salted.filter("many or (places > 1 and not lead)").select(*cols))
    routes = cold
    dealt = base.select(b, "did", "ver", "row")
    row_type = to_arrow_type(base.schema["row"].dataType)
    out = f"row {base.schema['row'].dataType.simpleString()}, n_words long, n_removed long, spans array<struct<start:long,end:long>>, kept string"
    return dealt.groupBy("b").cogroup(routes.groupBy("b")).applyInArrow(_results(window, row_type, text_col, layout), out)


def op1(docs: DataFrame) -> DataFrame:
    """The contract's digest of :func:`substring_dedup` with 20 words."""
    return substring_dedup(docs.select("doc_id", "text"), layout=False).select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with repeated passages taken out, the rest of a text as it stands; one with nothing left goes, one
    that had no words stays.  Cases are those of :func:`substring_dedup`."""
    out = substring_dedup(docs).filter("n_removed = 0 or n_removed < n_words")
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("row.text"))
    cols = [text.alias("text") if c == "text" else (F.when(F.col("n_removed") > 0, F.length("kept")).otherwise(F.col("row.n_chars")).cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col("row")[c].alias(c)) for c in docs.columns]
    return out.select(*cols)

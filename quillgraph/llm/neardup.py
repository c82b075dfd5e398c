"""MinHash near-dedup with HyperMinHash registers.

A document's word shingles are hashed into buckets; of each bucket's least hash a register keeps the count of leading
zeros and a few mantissa bits, 16 bits in all.  Four registers side by side are a band's key.  Documents with the same
set are one class and only its representative goes on.  Pairs that share a band are first judged by the estimate from
their registers, corrected for the collisions that so few bits cause, and then on their full sets.

Groups are never expanded into pairs.  In each of a few rounds, a band's documents are compared with one of them, chosen
by a hash, and linked documents become one component.  At the end the documents outside a band's largest component are
queries against the band's documents.  Both are dealt in blocks, and a block of queries meets a block of documents twice:
first as registers only, which rule out most documents; what remains comes with its text, and the pairs that still lie in
two components, each in the first band that they share, are compared on their full sets.  That gives a link for each
query and component at most.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import HOT, NULL_ID, discard, keyed, some, spread_join, written
from .words import U, grams, mix, sliced, within, words

REGISTERS, MANTISSA, ROWS = 128, 10, 4
BANDS = REGISTERS // ROWS
_BITS = REGISTERS.bit_length() - 1
#: Expected collisions of two registers, as the HyperMinHash paper approximates them, per 2 ** (buckets' bits - mantissa + 1).
COLLISION = 0.169919487159739
#: Standard deviations below the threshold at which the estimate alone rules a pair out.
SIGMAS = 5.0
ROUNDS = 2
#: A band's documents, and their shingles, in a block of the last comparison.
BLOCK, SHINGLES = 1024, 1 << 20
#: Where a register without a shingle looks for one to copy, in order.
_PROBES = (mix(np.arange(REGISTERS * 256, dtype=U)) % U(REGISTERS)).astype(np.int64).reshape(256, REGISTERS)


def shingle_sets(texts: list[str], k: int) -> list[np.ndarray]:
    """Each text's distinct shingles of k lower-cased (A-Z) words as sorted hashes; a shorter text is one shingle."""
    w = words(texts, lower=True)
    g = grams(w.hash, k)
    out = []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
        if b - a >= k:
            out.append(np.unique(g[a : b - k + 1]))
        else:
            out.append(grams(w.hash[a:b], b - a, 5) if b > a else np.zeros(0, U))
    return out


def registers(shingles: np.ndarray) -> np.ndarray:
    """HyperMinHash registers of a sorted set of hashes; registers without a shingle copy another's."""
    bucket = (shingles >> U(64 - _BITS)).astype(np.int64)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    least = (shingles[first] << U(_BITS)) | U((1 << _BITS) - 1)
    zeros = np.zeros(len(least), np.int64)
    for step in (32, 16, 8, 4, 2, 1):
        small = (least >> U(64 - step)) == 0
        zeros[small] += step
        least = np.where(small, least << U(step), least)
    value = (zeros << MANTISSA) | ((least << U(1)) >> U(64 - MANTISSA)).astype(np.int64)
    out, full = np.zeros(REGISTERS, np.int64), np.zeros(REGISTERS, bool)
    out[bucket[first]], full[bucket[first]] = value, True
    missing = np.flatnonzero(~full)
    for probe in _PROBES:
        if not len(missing):
            break
        found = full[probe[missing]]
        out[missing[found]] = out[probe[missing[found]]]
        missing = missing[~found]
    out[missing] = value[0]
    return out.astype(np.uint16)


def _signed(k: int):
    names = ["did", "ver", "n", "d1", "d2", "bands"]

    def run(batches):
        for b in sliced(batches, "text"):
            n, d1, d2, bands = [], [], [], []
            for s in shingle_sets(b.column("text").to_pylist(), k):
                n.append(len(s))
                d1.append(int(mix(s).sum(dtype=U).view(np.int64)))
                d2.append(int(mix(s ^ U(0x5BD1E995)).sum(dtype=U).view(np.int64)))
                bands.append(registers(s).view("<i8").tolist() if len(s) else [])
            cols = [pa.array(x, t) for x, t in ((n, pa.int64()), (d1, pa.int64()), (d2, pa.int64()), (bands, pa.list_(pa.int64())))]
            yield pa.RecordBatch.from_arrays([b.column("did"), b.column("ver"), *cols], names)

    return run


def _compared(k: int, percent: int):
    def run(batches):
        for b in batches:
            left, right = b.column("t1").to_pylist(), b.column("t2").to_pylist()
            distinct = list(set(left) | set(right))
            sets = dict(zip(distinct, shingle_sets(distinct, k), strict=True))
            keep = []
            for x, y in zip(left, right, strict=True):
                s, t = sets[x], sets[y]
                both = len(np.intersect1d(s, t, assume_unique=True))
                keep.append(100 * both >= percent * (len(s) + len(t) - both))
            yield pa.RecordBatch.from_arrays([b.column("u"), b.column("v")], ["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return run


def _estimated(percent: int, own: np.ndarray, n: int, others: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether the registers' estimate leaves pairs of one document (registers, shingles) with others possible."""
    accidents = COLLISION * 2.0 ** (_BITS - MANTISSA + 1) * 4.0 * n * sizes / (n + sizes) ** 2
    t, least = percent / 100, np.minimum(sizes, n)
    slack = SIGMAS * (t * (1 - t)) ** 0.5 / np.sqrt(np.minimum(REGISTERS, least / 2.0))
    able = least * 100 >= percent * np.maximum(sizes, n)
    return able & (((others == own).sum(1) - accidents) / REGISTERS >= t - slack)


class _Pair:
    """A block of queries and a block of documents of one band key: which pairs are still to be compared."""

    def __init__(self, t: pa.Table, percent: int):
        self.percent = percent
        asks = t.column("asks").to_numpy()
        self.q, self.m = np.flatnonzero(asks), np.flatnonzero(~asks)
        self.bands = np.array(t.column("bands").to_pylist(), np.int64)
        self.registers = self.bands.view(np.uint16)
        self.n = t.column("n").to_numpy()
        comps = [(c["did"], c["ver"]) for c in t.column("comp").to_pylist()]
        number = {c: i for i, c in enumerate(dict.fromkeys(comps))}
        self.comp = np.array([number[c] for c in comps])
        self.band = t.column("band")[0].as_py()

    def todo(self):
        """(query row, rows of documents) for each query with any."""
        m = self.m
        for i in self.q.tolist():
            other = m[self.comp[m] != self.comp[i]]
            # a pair belongs to the first band that it shares
            other = other[(self.bands[other] == self.bands[i]).argmax(1) == self.band]
            other = other[_estimated(self.percent, self.registers[i], self.n[i], self.registers[other], self.n[other])]
            if len(other):
                yield i, other


def _possible(percent: int):
    """The rows of a block pair that are in any pair still to be compared."""

    def run(t: pa.Table) -> pa.Table:
        keep = np.zeros(t.num_rows, bool)
        for i, other in _Pair(t, percent).todo():
            keep[i] = True
            keep[other] = True
        return t.filter(pa.array(keep))

    return run


def _blocked(k: int, percent: int):
    """Links between a block pair's queries and its documents of other components."""
    node = pa.struct([("did", pa.int64()), ("ver", pa.int64())])

    def run(t: pa.Table) -> pa.Table:
        found: list[tuple[dict, dict]] = []
        pair, sets, nodes = _Pair(t, percent), shingle_sets(t.column("text").to_pylist(), k), t.column("v").to_pylist()
        for i, other in pair.todo():
            s = sets[i]
            both = np.array([len(np.intersect1d(s, sets[j], assume_unique=True)) for j in other.tolist()])
            linked = other[100 * both >= percent * (len(s) + pair.n[other] - both)]
            _, first = np.unique(pair.comp[linked], return_index=True)
            found += [(nodes[i], nodes[j]) for j in linked[first].tolist()]
        return pa.table([pa.array([x for x, _ in found], node), pa.array([y for _, y in found], node)], ["u", "v"])

    return run


#: A document's key in pairs and components.
_V = "struct<did:long,ver:long>"


def _likely(percent: int):
    """Whether the registers' estimate leaves a pair possible: matches less expected collisions over registers."""
    lanes = "aggregate(zip_with(b1, b2, (x, y) -> x ^ y), 0, (n, z) -> n + if(z & 65535 = 0, 1, 0) + if(z & 4294901760 = 0, 1, 0) + if(z & 281470681743360 = 0, 1, 0) + if(shiftrightunsigned(z, 48) = 0, 1, 0))"
    spread = "(4.0 * n1 * n2 / ((n1 + n2) * double(n1 + n2)))"
    accidents = f"{COLLISION * 2.0 ** (_BITS - MANTISSA + 1)} * {spread}"
    t = percent / 100
    slack = f"{SIGMAS * (t * (1 - t)) ** 0.5} / sqrt(least({REGISTERS}, least(n1, n2) / 2.0))"
    return F.expr(f"least(n1, n2) * 100 >= greatest(n1, n2) * {percent} and ({lanes} - {accidents}) / {REGISTERS} >= {t} - {slack}")


def components(edges: DataFrame) -> DataFrame:
    """(v, comp): for each end of an edge (u, v) the least node that it reaches, by large and small stars in turn."""
    now = written(edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).filter("u != v").distinct(), "edges")
    mark = None
    while True:
        both = now.select("u", "v").unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("m").alias("u"), "v").distinct()
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(low, "v").select(F.col("m").alias("u"), F.explode(F.array("u", "v")).alias("v")).filter("u != v").distinct()
        new = written(small, "edges")
        n, total = new.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        discard(now)
        if (n, total) == mark:
            return new.select("v", F.col("u").alias("comp")).unionAll(new.select(F.col("u").alias("v"), F.col("u").alias("comp")).distinct())
        now, mark = new, (n, total)


def _settled(rest: DataFrame, texts: DataFrame, by: list[str], hot: DataFrame | None, shingle: int, percent: int) -> DataFrame:
    """Links among the bands' documents that still lie in several components, by blocks of queries and of documents."""
    weight = rest.groupBy(*by).agg(F.sum("n").alias("words"), F.max("size").alias("size"))
    blocks = F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("words") / SHINGLES)).cast("int")
    giant = rest.groupBy(*by, "comp").agg(F.count("*").alias("c")).groupBy(*by).agg(F.max(F.struct("c", "comp")).alias("g")).select(*by, F.col("g.comp").alias("giant"))
    facts = weight.select(*by, blocks.alias("blocks")).join(giant, by)
    own = F.pmod(F.xxhash64("v.did", "v.ver"), F.col("blocks")).cast("int")
    dealt = spread_join(rest.drop("size"), facts, by, hot, ["v"]).withColumn("own", own)
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    cols = ["v", "comp", "n", "bands"]
    asks = dealt.filter("comp != giant").select(*by, F.col("own").alias("q"), every.alias("m"), F.lit(True).alias("asks"), *cols)
    # documents go only to the blocks in which there are queries
    meets = asks.select(*by, "q", "m").distinct()
    members = dealt.select(*by, F.col("own").alias("m"), F.lit(False).alias("asks"), *cols)
    members = members.join(meets, [*by, "m"]).select(*by, "q", "m", "asks", *cols)
    shape = f"band int, key long, q int, m int, asks boolean, v {_V}, comp {_V}, n long, bands array<long>"
    pairs = asks.unionByName(members).select(*[x.split()[0] for x in shape.split(", ")])
    open_ = written(pairs.groupBy(*by, "q", "m").applyInArrow(_possible(percent), shape), "open")
    full = open_.join(texts, "v")
    out = written(full.groupBy(*by, "q", "m").applyInArrow(_blocked(shingle, percent), f"u {_V}, v {_V}"), "links")
    discard(open_)
    return out


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS, once: bool = False) -> DataFrame:
    """(row, n_shingles, component_id, kept), a row for each input row.

    Two documents are linked where 100 * |intersection| >= percent * |union| of their shingle sets; ``component_id`` is
    the least id reachable over links, and ``kept`` marks the document that has it.  Null and empty texts, and texts
    without words, have no shingles and no links.  Repeated or null ids: see :func:`shared.keyed`; of a component's rows
    with its least id, the one with the least version is kept, and rows alike in id and text share a result; with
    ``once`` only the first of them as JSON is given.  Other columns, clashing names too, travel in ``row``.  Empty input
    gives no rows.
    """
    base, alone = keyed(docs, id_col, text_col), keyed(docs, id_col, text_col, alone=True)
    signed = written(alone.select("did", "ver", "text").mapInArrow(_signed(shingle), "did long, ver long, n long, d1 long, d2 long, bands array<long>"), "signatures")
    heads = signed.filter("n > 0").groupBy("d1", "d2").agg(F.min(F.struct("did", "ver", "n", "bands")).alias("h"))
    heads = written(heads.select(F.struct("h.did", "h.ver").alias("v"), "h.n", "h.bands", "d1", "d2"), "classes")
    by = ["band", "key"]
    keys = heads.select("v", F.posexplode("bands").alias("band", "key"))
    shared = written(keys.groupBy(*by).agg(F.count("*").alias("c")).filter("c > 1"), "shared")
    # of each band's keys at most 1 / HOT are so frequent: the bound of what is broadcast
    hot = some(shared.filter(F.col("c") > max(100, HOT * heads.count())).select(*by), "hot")
    keys = written(spread_join(keys, shared.drop("c"), by, hot, ["v"]), "bands")
    banded = keys.select("v").distinct()
    at = (F.col("did") == F.col("v.did")) & (F.col("ver") == F.col("v.ver"))
    texts = written(alone.select("did", "ver", "text").join(banded, at).select("v", "text"), "texts")
    one = heads.join(banded, "v").select("v", "n", "bands")

    def verified(pairs: DataFrame) -> DataFrame:
        """Pairs (u, v) that are links; ``pairs`` as written, where there are none."""
        p = written(pairs.filter("u != v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "met")
        if p.isEmpty():
            return p
        # a document that very many are compared with, as the one chosen from a large band
        ends = p.select(F.explode(F.array("u", "v")).alias("w")).groupBy("w").agg(F.count("*").alias("c"))
        often = some(ends.filter(F.col("c") > max(100, HOT * p.count())).select("w"), "often")

        def with_(df: DataFrame, end: str, facts: DataFrame) -> DataFrame:
            return spread_join(df, facts.withColumnRenamed("w", end), [end], often and often.withColumnRenamed("w", end), ["v" if end == "u" else "u"])

        node, text = F.col("v").alias("w"), F.col("text")
        q = with_(p, "u", one.select(node, F.col("n").alias("n1"), F.col("bands").alias("b1")))
        q = with_(q, "v", one.select(node, F.col("n").alias("n2"), F.col("bands").alias("b2")))
        q = written(q.filter(_likely(percent)).select("u", "v"), "pairs")
        t = with_(q, "u", texts.select(node, text.alias("t1")))
        t = with_(t, "v", texts.select(node, text.alias("t2")))
        out = written(t.mapInArrow(_compared(shingle, percent), f"u {_V}, v {_V}"), "links")
        discard(p, q)
        return out

    def apart(comp: DataFrame | None, r: int = 0) -> DataFrame:
        """Bands' rows with components, where a band still holds several: their number and one row by a hash too."""
        now = keys.withColumn("comp", F.col("v")) if comp is None else keys.join(comp, "v", "left").withColumn("comp", F.coalesce("comp", "v"))
        centre = F.min(F.struct(F.xxhash64(F.lit(r), "v.did", "v.ver").alias("x"), "v", "comp")).alias("c")
        several = now.groupBy(*by).agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("size"), centre)
        return spread_join(now, several.filter("low != high").drop("low", "high"), by, hot, ["v"])

    links, comp = None, None

    def linked(new: DataFrame) -> None:
        nonlocal links, comp
        if not new.isEmpty():
            links = new if links is None else links.unionAll(new)
            comp = components(links)

    for r in range(rounds):
        linked(verified(apart(comp, r).filter("comp != c.comp").select(F.col("c.v").alias("u"), "v")))
    rest = written(apart(comp).select(*by, "v", "comp", "size").join(one, "v"), "rest")
    if not rest.isEmpty():
        linked(_settled(rest, texts, by, hot, shingle, percent))
    discard(shared, keys, texts, rest)
    n = F.col("n")
    members = signed.drop("bands").join(heads.select("d1", "d2", "v"), ["d1", "d2"], "left")
    if comp is not None:
        members = members.join(comp, "v", "left")
    else:
        members = members.withColumn("comp", F.lit(None).cast(_V))
    own = F.struct("did", "ver")
    root = F.when(n > 0, F.coalesce("comp", "v")).otherwise(own)
    found = members.select(F.col("did").alias("i"), F.col("ver").alias("r"), n.alias("n_shingles"), root.alias("root"), (root == own).alias("kept"))
    out = (alone if once else base).select("row", "did", "ver").join(found, (F.col("did") == F.col("i")) & (F.col("ver") == F.col("r")))
    return out.select("row", "n_shingles", F.when(F.col("root.did") != NULL_ID, F.col("root.did")).alias("component_id"), "kept")


def op7(docs: DataFrame) -> DataFrame:
    """The contract's columns, on shingles of two words."""
    return near_duplicates(docs.select("doc_id", "text"), shingle=2).select("row.doc_id", "n_shingles", "component_id", "kept")


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, on shingles of five words.  Cases are those of
    :func:`near_duplicates` with ``once``."""
    return near_duplicates(docs, once=True).filter("kept").select("row.*")

"""Joining texts to a dictionary of names, and what follows: modes, areas and typed edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import vocab as V
from ..functions.text import tokens

BLOCKED = V.BLOCKED
#: Bytes up to which a dictionary is broadcast.
SMALL = 64 << 20


def phrases(df: DataFrame, key: str, text: str, lengths: Column, *more: str) -> DataFrame:
    """(key, more, phrase): the distinct runs of as many tokens as ``lengths``, an array, has."""
    t = df.select(F.col(key).alias("key"), *more, tokens(F.col(text)).alias("t"), lengths.alias("lengths"))
    runs = F.expr("flatten(transform(lengths, k -> if(size(t) >= k, transform(sequence(0, size(t) - k), i -> array_join(slice(t, i + 1, k), ' ')), cast(array() as array<string>))))")
    return t.select("key", *more, F.explode(F.array_distinct(runs)).alias("phrase"))


def _likely(d: DataFrame, n: DataFrame, longest: int) -> DataFrame:
    """(key, context, phrase): of ``d``'s runs of tokens those that are a name of one token, or begin with a longer name's
    first two tokens and have its length.  ``n`` is small enough to be broadcast."""
    t = d.select("key", "context", tokens(F.col("text")).alias("t"))
    w = t.select("key", "context", F.explode(F.expr(f"if(size(t) > 0, transform(sequence(1, size(t)), i -> slice(t, i, {longest})), null)")).alias("w"))
    one = n.filter("k = 1").select(F.col("phrase").alias("only")).distinct()
    more = n.filter("k > 1").groupBy(F.substring_index("phrase", " ", 2).alias("head")).agg(F.collect_set("k").alias("ks"))
    w = w.join(F.broadcast(one), F.get("w", F.lit(0)) == F.col("only"), "left").join(F.broadcast(more), F.array_join(F.slice("w", 1, 2), " ") == F.col("head"), "left")
    none = F.array().cast("array<int>")
    lengths = F.concat(F.when(F.col("only").isNotNull(), F.array(F.lit(1))).otherwise(none), F.coalesce("ks", none))
    w = w.filter("only is not null or head is not null").select("key", "context", "w", F.explode(lengths).alias("k")).filter("size(w) >= k")
    return w.select("key", "context", F.array_join(F.slice("w", 1, F.col("k")), " ").alias("phrase"))


def matched(df: DataFrame, key: str, text: str, names: DataFrame, context: str | None = None, never: tuple[str, ...] = BLOCKED) -> DataFrame:
    """(key, entity_id, cluster) for names found whole in a text, by an equi-join on phrases instead of a contains join.

    ``names`` has entity_id, name and cluster; names may have any number of tokens.  A name counts, in this order: never
    if it is in ``never``; where the text's cluster (its column ``context``) is the name's, in any case; not if it needs
    its cluster, or if several clusters have it; from FREE_LENGTH letters; from UNIQUE_LENGTH letters, as one cluster
    alone has it.  Null texts and names match nothing.

    Runs that no name has are dropped before any shuffle where the dictionary is small enough to be broadcast, which its
    measured size decides; beyond that the join is by shuffle.
    """
    n = names.select("entity_id", "name", "cluster", F.lower("name").alias("low"), tokens(F.col("name")).alias("t"))
    n = n.filter((F.size("t") > 0) & ~F.col("low").isin(*never))
    c, w = F.coalesce("cluster", F.lit("")), Window.partitionBy("low")
    n = n.withColumn("unique", F.min(c).over(w) == F.max(c).over(w))
    free = F.col("unique") & ~F.col("low").isin(*V.NEEDS_CLUSTER) & (F.length("name") >= V.UNIQUE_LENGTH)
    n = n.select("entity_id", "cluster", F.array_join("t", " ").alias("phrase"), F.size("t").alias("k"), free.alias("free"))
    if context is None:
        n = n.filter("free")  # no text has a cluster
    size = n.agg(F.sum(F.octet_length("phrase") + F.octet_length(F.col("entity_id").cast("string")) + 64).alias("bytes"), F.collect_set("k").alias("lengths")).first()
    lengths = sorted(size["lengths"] or [])
    d = df.select(F.col(key).alias("key"), F.col(text).alias("text"), F.lower(F.coalesce(F.col(context), F.lit("")) if context else F.lit("")).alias("context"))
    if (size["bytes"] or 0) <= SMALL:
        found = _likely(d, n, max(lengths, default=1)).join(F.broadcast(n), "phrase")
    else:
        found = phrases(d, "key", "text", F.array(*[F.lit(k) for k in lengths]), "context").join(n, "phrase")
    same = (F.col("context") != "") & (F.lower("cluster") == F.col("context"))
    return found.filter(F.coalesce(same, F.lit(False)) | F.col("free")).select("key", "entity_id", "cluster").distinct()


def test_mode(tc_id: Column, text: Column, refs: Column, prefixes: Column | None = None) -> Column:
    """cluster_centric, protocol_behavior_centric, mixed or ambiguous.

    A protocol prefix of the id decides, as does a prefix outside ``prefixes``, the known ones of clusters, where they are
    given.  Else hits in the text and half a point for each reference, canonical or protocol, give a share.
    """
    prefix = F.upper(F.regexp_extract(tc_id, r"(?i)^TC-([A-Z0-9]+)-", 1))
    protocol = prefix.isin(*V.PROTOCOL_PREFIXES)
    if prefixes is not None:
        protocol = protocol | ((F.size(prefixes) > 0) & ~F.array_contains(prefixes, prefix))
    p_refs = F.size(F.filter(refs, lambda r: r.startswith("PROTO::")))
    c = F.regexp_count(text, F.lit(V.CLUSTER_MODE)) + 0.5 * (F.size(refs) - p_refs)
    p = F.regexp_count(text, F.lit(V.PROTOCOL_MODE)) + 0.5 * p_refs
    share = c / (c + p)
    by_text = F.when(c + p == 0, "ambiguous").when(share >= V.MODE_HIGH, "cluster_centric").when(share <= V.MODE_LOW, "protocol_behavior_centric").otherwise("mixed")
    return F.when((prefix != "") & protocol, "protocol_behavior_centric").otherwise(by_text)


def areas(breadcrumb: Column) -> Column:
    """Nodes of a breadcrumb's segments of three letters or more, section numbers taken off, outermost first."""
    parts = F.transform(F.split(breadcrumb, ">"), lambda x: F.trim(F.regexp_replace(F.trim(x), V.SECTION_NUMBER, "")))
    slugs = F.transform(F.filter(parts, lambda x: F.length(x) >= 3), lambda x: F.btrim(F.regexp_replace(x, "[^A-Za-z0-9]+", "_"), F.lit("_")))
    return F.transform(F.filter(slugs, lambda x: x != ""), lambda x: F.concat(F.lit("PROTOCOL_AREA::"), x))


def typed_edges(tests: DataFrame, table: dict[str, dict[str, str]], fallback: dict[str, str]) -> DataFrame:
    """(tc_id, entity_id, edge_type) from (tc_id, entity_id, entity_type, intents): the first intent that suits the type."""
    spark = tests.sparkSession
    rows = [(i, t, e) for i, ts in table.items() for t, e in ts.items()]
    literal = F.broadcast(spark.createDataFrame(rows, "intent string, entity_type string, edge string"))  # a literal of a few rows
    each = tests.select("tc_id", "entity_id", "entity_type", F.posexplode_outer("intents").alias("pos", "intent")).join(literal, ["intent", "entity_type"], "left")
    first = each.groupBy("tc_id", "entity_id", "entity_type").agg(F.min(F.when(F.col("edge").isNotNull(), F.struct("pos", "edge"))).alias("f"))
    other = F.create_map(*[F.lit(x) for kv in fallback.items() for x in kv])
    return first.select("tc_id", "entity_id", F.coalesce("f.edge", F.try_element_at(other, "entity_type"), F.lit("tests")).alias("edge_type"))

"""Data-model XML to entities, with inheritance from a base cluster."""

from __future__ import annotations

import xml.etree.ElementTree as ET

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Element names to entity types.
ENTITIES = {"attribute": "attribute", "command": "command", "event": "event", "feature": "feature"}
_CONFORM = {"mandatoryConform": "M", "optionalConform": "O", "disallowConform": "X", "deprecateConform": "D"}


def _plain(tag: str) -> str:
    return tag.rpartition("}")[2]


def entities(xml: str | None) -> list[dict[str, str]]:
    """One row for each entity of each cluster; direct children or wrapped, attributes or child elements."""
    try:
        root = ET.fromstring(xml or "")
    except ET.ParseError:
        return []
    out, seen = [], set()
    clusters = [e for e in root.iter() if _plain(e.tag) == "cluster"]
    for cluster in clusters:
        name = cluster.get("name", "")
        base = next((c.get("baseCluster", "") for c in cluster.iter() if c.get("baseCluster")), "")
        for e in cluster.iter():
            kind = ENTITIES.get(_plain(e.tag))
            key = (name, kind, e.get("name"))
            if not kind or not e.get("name") or key in seen:
                continue
            seen.add(key)
            found = [_CONFORM[_plain(c.tag)] for c in e if _plain(c.tag) in _CONFORM]
            access = next((c for c in e if _plain(c.tag) == "access"), None)
            out.append({"cluster": name, "base": base, "entity_type": kind, "name": e.get("name"), "code": e.get("id") or e.get("code") or "", "datatype": e.get("type", ""), "conformance": e.get("conformance") or (found[0] if found else ""), "access": e.get("access") or ("" if access is None else " ".join(f"{k}={v}" for k, v in sorted(access.attrib.items())))})
    return out


def inherited(entities: DataFrame) -> DataFrame:
    """A derived cluster's empty fields from its base by (type, name), and the base's other entities added to it."""
    base = entities.select(F.col("cluster").alias("b"), F.col("entity_type").alias("b_type"), F.col("name").alias("b_name"), *[F.col(c).alias(f"b_{c}") for c in ("code", "datatype", "conformance", "access")])
    j = entities.join(base, (F.col("base") == F.col("b")) & (F.col("entity_type") == F.col("b_type")) & (F.col("name") == F.col("b_name")), "left")
    filled = j.select("cluster", "base", "entity_type", "name", *[F.coalesce(F.nullif(F.col(c), F.lit("")), F.col(f"b_{c}"), F.lit("")).alias(c) for c in ("code", "datatype", "conformance", "access")])
    derived = entities.filter("base <> ''").select(F.col("cluster").alias("d"), F.col("base").alias("of")).distinct()
    own = entities.select(F.col("cluster").alias("d2"), F.col("entity_type").alias("t2"), F.col("name").alias("n2"))
    extra = derived.join(entities, F.col("of") == F.col("cluster")).drop("cluster", "base")
    extra = extra.join(own, (F.col("d") == F.col("d2")) & (F.col("entity_type") == F.col("t2")) & (F.col("name") == F.col("n2")), "left_anti")
    return filled.unionByName(extra.withColumnsRenamed({"d": "cluster", "of": "base"}).select(*filled.columns))


_COLUMNS = ("cluster", "base", "entity_type", "name", "code", "datatype", "conformance", "access")


def entity_rows(files: DataFrame, path_col: str = "path", text_col: str = "content") -> DataFrame:
    """(path, cluster, base, entity_type, name, code, datatype, conformance, access): the entities of data-model files, in
    the standard dialect or the alternate one.  What can't be parsed has none."""

    def run(batches):
        for b in batches:
            rows = [(p, *[e[c] for c in _COLUMNS]) for p, x in zip(b.column("path").to_pylist(), b.column("xml").to_pylist(), strict=True) for e in (alternate(x) if is_alternate(x) else entities(x))]
            cols = list(zip(*rows, strict=True)) or [[]] * 9
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in cols], ["path", *_COLUMNS])

    shape = ", ".join(f"{c} string" for c in ("path", *_COLUMNS))
    return files.select(F.col(path_col).cast("string").alias("path"), F.col(text_col).cast("string").alias("xml")).mapInArrow(run, shape)


def is_alternate(xml: str | None) -> bool:
    """Whether a file is of the alternate dialect: a configurator with clusters that have a define."""
    return "<configurator" in (xml or "") and "<define>" in (xml or "")


#: Type names of the alternate dialect.
ALTERNATE_TYPES = {"int8u": "uint8", "int16u": "uint16", "int24u": "uint24", "int32u": "uint32", "int64u": "uint64", "int8s": "int8", "int16s": "int16", "int32s": "int32", "int64s": "int64", "boolean": "bool", "char_string": "string", "long_char_string": "string", "octet_string": "octstr", "long_octet_string": "octstr", "array": "list"}


def alternate(xml: str | None) -> list[dict[str, str]]:
    """Entities of the alternate dialect, in the standard one's terms."""
    try:
        root = ET.fromstring(xml or "")
    except ET.ParseError:
        return []
    out, seen = [], set()
    for cluster in (e for e in root.iter() if _plain(e.tag) == "cluster"):
        name = next((c.text or "" for c in cluster if _plain(c.tag) == "name"), "").strip()
        for e in cluster.iter():
            kind = ENTITIES.get(_plain(e.tag))
            own = e.get("name") or (e.text or "").strip()
            if not kind or not own or (kind, own) in seen:
                continue
            seen.add((kind, own))
            optional = e.get("optional", "").lower() == "true"
            access = "RW" if e.get("writable", "").lower() == "true" else "R" if kind == "attribute" else ""
            out.append({"cluster": name, "base": "", "entity_type": kind, "name": own, "code": e.get("code") or e.get("bit") or "", "datatype": ALTERNATE_TYPES.get(e.get("type", "").lower(), e.get("type", "")), "conformance": "O" if optional else "M", "access": access})
    return out


def feature_conditions(xml: str | None) -> list[str]:
    """Names of the features that conditions ask for, in the order in which a stack meets them."""
    try:
        root = ET.fromstring(xml or "")
    except ET.ParseError:
        return []
    out, stack = [], [root]
    while stack:
        e = stack.pop()
        if _plain(e.tag) in ("feature", "condition") and e.get("name"):
            out.append(e.get("name"))
        stack.extend(e)
    return list(dict.fromkeys(out))


def canonical(entities_: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """(entity_id, entity_type, name, cluster, ...): one row for each entity of a cluster, the first file's; an alias
    (name, base) has all entities of its base under its own name."""
    w = Window.partitionBy("cluster", "entity_type", "name").orderBy("path")
    e = entities_.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")
    if aliases is not None:
        a = aliases.select(F.col("name").alias("_alias"), F.col("base").alias("cluster"))
        copies = e.join(a, "cluster").withColumn("cluster", F.col("_alias")).drop("_alias")
        have = e.select("cluster", "entity_type", "name")
        e = e.unionByName(copies.join(have, ["cluster", "entity_type", "name"], "left_anti"))
    return e.withColumn("entity_id", F.concat_ws("::", F.upper("entity_type"), "cluster", "name"))


def cluster_texts(entities_: DataFrame) -> DataFrame:
    """(cluster, text): a cluster with its entities as a text to search in."""
    line = F.concat(F.col("entity_type"), F.lit(" "), F.col("name"), F.when(F.col("code") != "", F.concat(F.lit(" ("), F.col("code"), F.lit(")"))).otherwise(""), F.when(F.col("conformance") != "", F.concat(F.lit(" "), F.col("conformance"))).otherwise(""))
    lines = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("entity_type", "code", "name", line.alias("l")))), lambda x: x.l), "\n")
    return entities_.groupBy("cluster").agg(F.concat(F.lit("Cluster: "), F.first("cluster"), F.lit("\n"), lines).alias("text"))

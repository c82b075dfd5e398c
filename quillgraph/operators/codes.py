"""Codes of the protocol-implementation statement: their schema from a data model, extraction and validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab as V

_ID = "conv(regexp_extract({c}, '^(?:0[xX])?([0-9a-fA-F]+)$', 1), 16, 10)"


def code_schema(clusters: DataFrame, entities: DataFrame) -> DataFrame:
    """(prefix, side, kind, entity_id, name, mandatory, disallowed): a row for each code that a data model allows to be
    asked for.

    ``clusters``: name, pics_code, base_cluster, hierarchy.  ``entities``: cluster, entity_type, name, code (hex or bit),
    conformance, direction.  Attributes, events and features are the server's; a command is its receiver's.  An alias has
    its base's entities under its own prefix, its own where it has them.
    """
    kinds = F.create_map(*[F.lit(x) for k, v in V.CODE_KINDS.items() for x in (v, k)])
    e = entities.select("cluster", F.try_element_at(kinds, F.lower("entity_type")).alias("kind"), "name", F.expr(_ID.format(c="coalesce(code, '')")).cast("long").alias("entity_id"), F.upper(F.coalesce("conformance", F.lit(""))).alias("conf"), F.lower(F.coalesce("direction", F.lit(""))).alias("direction"))
    e = e.filter("kind is not null and entity_id is not null")
    side = F.when((F.col("kind") == "C") & F.col("direction").rlike("(fromserver|servertoclient|response|client$)"), "C").otherwise("S")
    e = e.withColumn("side", side).drop("direction")
    own = clusters.select(F.col("name").alias("cluster"), F.upper("pics_code").alias("prefix"), "base_cluster", "hierarchy").filter("prefix is not null and prefix != ''")
    direct = own.join(e, "cluster").withColumn("rank", F.lit(0))
    from_base = own.filter("base_cluster != ''").drop("cluster").withColumnRenamed("base_cluster", "cluster").join(e, "cluster").withColumn("rank", F.lit(1))
    cols = ["prefix", "side", "kind", "entity_id"]
    every = direct.select(*cols, "name", "conf", "rank").unionByName(from_base.select(*cols, "name", "conf", "rank"))
    best = every.groupBy(*cols).agg(F.min(F.struct("rank", "name", "conf")).alias("m"))
    return best.select(*cols, "m.name", (F.col("m.conf") == "M").alias("mandatory"), F.col("m.conf").isin("X", "D").alias("disallowed"))


def codes_in(text: Column, gates: bool = True) -> Column:
    """Distinct codes of a text in order: with an id, and the two-part ones that gate a whole side where ``gates`` is on."""
    pattern = V.CODE[:-len(r"\.([ACEF])([0-9a-fA-F]{2,4})")] + r"(?:\.[ACEF][0-9a-fA-F]{2,4}(?:\.\w+)?)" + ("?" if gates else "")
    return F.array_distinct(F.regexp_extract_all(text, F.lit(pattern + r"(?![0-9A-Za-z])"), F.lit(0)))


def case_codes(test_cases: DataFrame) -> DataFrame:
    """(tc_id, codes): of the list of codes all, of the other texts those with an id."""
    t = test_cases.select("tc_id", F.array_join(F.coalesce("pics_codes", F.array().cast("array<string>")), " ").alias("l"), F.concat_ws(" ", "purpose", "prerequisites", "setup", F.array_join(F.coalesce("procedure_steps", F.array().cast("array<string>")), " ")).alias("t"))
    return t.select("tc_id", F.array_distinct(F.concat(codes_in(F.col("l")), codes_in(F.col("t"), False))).alias("codes"))


def parsed(code: Column) -> dict[str, Column]:
    """prefix, side, kind and id of a code; notes in brackets and a response's ending don't count."""
    plain = F.regexp_replace(F.regexp_replace(code, r"\(.*?\)", ""), r"(?i)\.Rsp$", "")
    part = lambda n: F.regexp_extract(F.trim(plain), "^" + V.CODE + "$", n)
    return {"prefix": part(1), "side": part(2), "kind": part(3), "entity_id": F.when(part(4) != "", F.conv(part(4), 16, 10).cast("long"))}


def validated(codes: DataFrame, schema: DataFrame, code: str = "code") -> DataFrame:
    """Add ``valid`` and ``error_type``: invalid_format; unknown_cluster, which can't be judged and so is valid; unknown_id.

    An attribute may be the server's under either side, and a client's command may be among the server's.
    """
    p = parsed(F.col(code))
    df = codes.withColumns({f"_{k}": v for k, v in p.items()})
    known = schema.select(F.col("prefix").alias("_prefix")).distinct().withColumn("_known", F.lit(True))
    ids = schema.select(F.col("prefix").alias("_prefix"), F.col("kind").alias("_kind"), F.col("entity_id").alias("_entity_id"), "side").groupBy("_prefix", "_kind", "_entity_id").agg(F.collect_set("side").alias("_sides"))
    df = df.join(F.broadcast(known), "_prefix", "left").join(ids, ["_prefix", "_kind", "_entity_id"], "left")
    sides = F.coalesce("_sides", F.array().cast("array<string>"))
    either = F.array_contains(sides, F.col("_side")) | F.array_contains(sides, "S")
    fits = F.when(F.col("_kind").isin("A", "C"), either).when(F.col("_kind") == "F", F.size(sides) > 0).otherwise(F.lit(True))
    error = F.when(F.col("_prefix") == "", "invalid_format").when(F.col("_known").isNull(), "unknown_cluster").when(~fits, "unknown_id").otherwise("")
    return df.withColumn("error_type", error).withColumn("valid", F.col("error_type").isin("", "unknown_cluster")).drop("_prefix", "_side", "_kind", "_entity_id", "_known", "_sides")


def findings(test_cases: DataFrame, schema: DataFrame) -> DataFrame:
    """(tc_id, code, finding): non_existent, an id that the prefix's schema doesn't have; wrong_side, an id that only the
    other side has; dut_type_mismatch, a code of the other side than the test case's role.  Disallowed ids, foreign prefixes
    and codes of a whole side aren't judged.  ``test_cases``: tc_id, dut_type, pics_codes and texts."""
    each = case_codes(test_cases).select("tc_id", F.explode("codes").alias("code")).join(test_cases.select("tc_id", F.lower(F.coalesce("dut_type", F.lit(""))).alias("role")), "tc_id")
    each = each.withColumns({f"_{k}": v for k, v in parsed(F.col("code")).items()}).filter("_prefix != ''")
    known = F.broadcast(schema.select(F.col("prefix").alias("_prefix")).distinct())
    ids = schema.groupBy(F.col("prefix").alias("_prefix"), F.col("kind").alias("_kind"), F.col("entity_id").alias("_entity_id")).agg(F.collect_set("side").alias("sides"), F.max("disallowed").alias("disallowed"))
    j = each.join(known, "_prefix").join(ids, ["_prefix", "_kind", "_entity_id"], "left").filter("not coalesce(disallowed, false)")
    own = F.col("_side")
    other = (F.col("role").isin("server", "client")) & (F.when(F.col("role") == "server", "S").otherwise("C") != own)
    finding = F.when(F.col("sides").isNull(), "non_existent").when(~F.array_contains("sides", own), "wrong_side").when(other, "dut_type_mismatch")
    return j.select("tc_id", "code", finding.alias("finding")).filter("finding is not null")


def schema_text(schema: DataFrame) -> DataFrame:
    """(prefix, text): the schema in lines, a side and kind each, mandatory ids marked."""
    entry = F.concat(F.lpad(F.hex("entity_id"), 4, "0"), F.lit(" "), "name", F.when(F.col("mandatory"), " (M)").when(F.col("disallowed"), " (X)").otherwise(""))
    lines = schema.groupBy("prefix", "side", "kind").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("entity_id", entry.alias("e")))), lambda x: x.e), ", ").alias("l"))
    line = F.concat_ws(".", "side", "kind")
    return lines.groupBy("prefix").agg(F.array_join(F.array_sort(F.collect_list(F.concat(line, F.lit(": "), "l"))), "\n").alias("text"))

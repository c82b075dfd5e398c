"""Ids in texts: many replaced at once, and new test cases numbered on with their texts rewritten."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab as V
from .entities import SMALL
from .lineage import cut
from .ranges import numbered

#: Tasks over which the rows of one id are dealt where the table of ids is too large to be sent to every task.
SALTS = 16
#: Distinct ids of a row that are looked up one after another in a table that every task has.
LOOKUPS = 8


def _put(text: Column, pattern: str, new, met: Column | None = None) -> Column:
    """A text with each match of ``pattern``, found before as ``met``, replaced by ``new(match)``, where that is not null.

    Matches are found once, so no replacement is replaced again, and an id that begins another is not met within it.
    """
    between, met = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), 0) if met is None else met
    return F.array_join(F.zip_with(between, met, lambda b, m: F.concat(b, F.coalesce(new(m), m, F.lit("")))), "")


def rewritten(df: DataFrame, texts: list[str], ids: DataFrame, pattern: str = V.CASE_NUMBER) -> DataFrame:
    """``df`` with all ids in ``texts`` replaced at once by what ``ids``, (old, new), says: A to B and B to A at the same time.

    An id is a whole match of ``pattern``; one that ``ids`` doesn't know stays.  An old id that has several new ones gets the
    smallest; rows of ``ids`` with a null don't count.  Null texts stay null, repeated rows stay repeated, other columns as
    as they are; a column whose name begins with ``_row`` is an error.  A table of ids of up to 64 MB goes to every task, where
    rows with up to LOOKUPS distinct ids look them up without a shuffle; ``df`` is read once more to tell how many they have.
    Of rows with more a number and the distinct ids are joined; beyond 64 MB that is so for all, an id's rows dealt to 16.
    """
    if any(c.startswith("_row") for c in df.columns):
        raise ValueError("a column's name may not begin with _row")
    ids = cut(ids.filter("old is not null and new is not null").groupBy("old").agg(F.min("new").alias("new")))
    met = F.flatten(F.array(*[F.coalesce(F.regexp_extract_all(c, F.lit(pattern), 0), F.array().cast("array<string>")) for c in texts]))
    met = F.array_distinct(met)
    small = (ids.agg(F.sum(F.octet_length("old") + F.octet_length("new")).alias("bytes")).first()["bytes"] or 0) <= SMALL
    if not small:
        return _joined(df, texts, ids, pattern, met, small)
    most = df.agg(F.max(F.size(met)).alias("n")).first()["n"] or 0
    if most <= LOOKUPS:
        return _looked_up(df, texts, ids, pattern, most)
    more = _joined(df.filter(F.size(met) > LOOKUPS), texts, ids, pattern, met, small)
    return _looked_up(df.filter(F.size(met) <= LOOKUPS), texts, ids, pattern, LOOKUPS).unionByName(more)


def _looked_up(df: DataFrame, texts: list[str], ids: DataFrame, pattern: str, most: int) -> DataFrame:
    """``df``, whose rows have up to ``most`` ids, with each id's new one from a broadcast join of its own."""
    if not most:
        return df
    found = {c: f"_row_met{i}" for i, c in enumerate(texts)}
    out = df.withColumns({m: F.coalesce(F.regexp_extract_all(c, F.lit(pattern), 0), F.array().cast("array<string>")) for c, m in found.items()})
    out = out.withColumn("_row_ids", F.array_distinct(F.flatten(F.array(*found.values()))))
    for i in range(most):
        one = ids.select(F.col("old").alias(f"_row_old{i}"), F.col("new").alias(f"_row_new{i}"))
        out = out.join(F.broadcast(one), F.get("_row_ids", F.lit(i)) == F.col(f"_row_old{i}"), "left")
    new = [F.col(f"_row_new{i}") for i in range(most)]
    of = lambda m: F.get(F.array(*new), (F.array_position("_row_ids", m) - 1).cast("int"))
    return out.withColumns({c: F.when(F.coalesce(*new).isNull(), F.col(c)).otherwise(_put(F.col(c), pattern, of, F.col(found[c]))) for c in texts}).select(*df.columns)


def _joined(df: DataFrame, texts: list[str], ids: DataFrame, pattern: str, met: Column, small: bool) -> DataFrame:
    """``df`` with rows numbered and written, joined with the ids that they have and put together again by their number."""
    rows = cut(df.withColumn("_row", F.monotonically_increasing_id()))
    met = rows.select("_row", F.explode(met).alias("old"))
    if small:
        pairs = met.join(F.broadcast(ids), "old")
    else:
        dealt = ids.withColumn("_salt", F.explode(F.array(*[F.lit(i) for i in range(SALTS)])))
        pairs = met.withColumn("_salt", (F.pmod(F.xxhash64("_row"), F.lit(SALTS))).cast("int")).join(dealt, ["old", "_salt"])
    known = pairs.groupBy("_row").agg(F.map_from_entries(F.collect_list(F.struct("old", "new"))).alias("_new"))
    out = rows.join(known, "_row", "left")
    return out.withColumns({c: F.when(F.col("_new").isNull(), F.col(c)).otherwise(_put(F.col(c), pattern, lambda m: F.try_element_at("_new", m))) for c in texts}).select(*df.columns)


def renumbered_cases(items: DataFrame, existing: DataFrame, key: str, title: str, body: str) -> DataFrame:
    """``items`` with ``tc_id``: proposed test cases numbered on from the highest minor number in ``existing`` (tc_id).

    Items are grouped by prefix and major number of the first id in their title and numbered in the order of the title
    without ids, lower-cased and trimmed, then ``key``.  The item's old id, as a whole, becomes the new one in its title and
    body, other ids stay.  Items without an id, with a null title, or with numbers beyond a long keep their texts and have a
    null ``tc_id``.  Groups are numbered by ranges, so no task holds one.
    """
    part = lambda c, i: F.regexp_extract(c, V.CASE_NUMBER, i)
    old = F.regexp_extract(title, V.CASE_NUMBER, 0)
    number = lambda c, i: F.when(part(c, i) != "", part(c, i)).try_cast("long")
    top = existing.select(part("tc_id", 1).alias("_prefix"), number("tc_id", 2).alias("_major"), number("tc_id", 3).alias("_minor"))
    top = top.filter("_minor is not null").groupBy("_prefix", "_major").agg(F.max("_minor").alias("_top"))
    df = items.withColumns({"_prefix": part(title, 1), "_major": number(title, 2), "_minor": number(title, 3), "_old": old, "_sort": F.lower(F.trim(F.regexp_replace(title, V.CASE_NUMBER, "")))})
    has = F.coalesce((F.col("_prefix") != "") & F.col("_major").isNotNull() & F.col("_minor").isNotNull(), F.lit(False))
    df = cut(df)
    first = df.filter(~has).withColumn("tc_id", F.lit(None).cast("string"))
    rest = numbered(df.filter(has), ["_prefix", "_major"], ["_sort", key], "_at").join(top, ["_prefix", "_major"], "left")
    rest = rest.withColumn("tc_id", F.concat("_prefix", F.lit("-"), F.col("_major"), F.lit("."), F.coalesce("_top", F.lit(0)) + F.col("_at") + 1))
    rest = rest.withColumn("tc_id", F.concat(F.lit("TC-"), "tc_id"))
    rest = rest.withColumns({c: _put(F.col(c), V.CASE_NUMBER, lambda m: F.when(m == F.col("_old"), F.col("tc_id"))) for c in (title, body)})
    return first.select(*items.columns, "tc_id").unionByName(rest.select(*items.columns, "tc_id"))

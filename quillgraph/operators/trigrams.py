"""Which texts hold which others, by rarest grams and verification instead of a comparison of all with all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lineage import cut

#: Lengths of the grams by which needles are looked up: of each needle the longest that fits.
SIZES = (1, 2, 3, 4, 6, 12, 24)
#: Grams asked for, of one length, up to which they go to every task; beyond, the texts' grams are shuffled to them.
SENT = 1 << 17


def grams(text: Column, n: int = 3) -> Column:
    """Distinct runs of ``n`` characters; none for shorter texts."""
    all_ = F.transform(F.sequence(F.lit(1), F.length(text) - n + 1), lambda i: F.substring(text, i, F.lit(n)))
    return F.when(F.length(text) >= n, F.array_distinct(all_)).otherwise(F.array().cast("array<string>"))


def _hashes(text: Column, n: int) -> Column:
    return F.transform(grams(text, n), lambda g: F.xxhash64(g))


def _postings(texts: DataFrame, asked: DataFrame) -> DataFrame:
    """(size, gram, id): which texts (id, text) have the grams asked for (size, gram), by lengths of grams."""
    parts = None
    for r in asked.groupBy("size").agg(F.count_distinct("gram").alias("n")).orderBy("size").collect():  # a row for each of SIZES at most
        wanted = asked.filter(F.col("size") == r["size"]).select("gram").distinct()
        own = texts.select(F.lit(r["size"]).alias("size"), "id", F.explode(_hashes(F.col("text"), r["size"])).alias("gram"))
        own = own.join(F.broadcast(wanted) if r["n"] <= SENT else wanted.hint("merge"), "gram", "left_semi").select("size", "gram", "id")
        parts = own if parts is None else parts.unionByName(own)
    return parts if parts is not None else texts.filter("false").select(F.lit(0).alias("size"), F.lit(0).cast("long").alias("gram"), "id")


def contained(needles: DataFrame, texts: DataFrame) -> DataFrame:
    """(needle, text): all pairs of a distinct non-empty ``needle`` and a distinct ``text`` that holds it, cases as they are.

    Of each needle the gram that the fewest texts have is joined to the table of grams, and what that leaves is verified; a
    needle with a gram that no text has meets nothing.  Grams are as long as the needle allows, so the texts with the rarest
    are few more than those with the needle however many texts there are.  The table has hashes and numbers of texts only,
    is cut to the needles' grams before it is shuffled, and written, as it is read twice.  Nulls hold nothing and are held by
    nothing.
    """
    n = needles.select("needle").filter("needle is not null and needle != ''").distinct()
    t = cut(texts.select("text").filter("text is not null").distinct().withColumn("id", F.monotonically_increasing_id()))
    size = F.coalesce(*[F.when(F.length("needle") >= k, k) for k in reversed(SIZES)])
    own = F.coalesce(*[F.when(size == k, _hashes(F.col("needle"), k)) for k in SIZES])
    asked = cut(n.select("needle", size.alias("size"), F.explode(own).alias("gram")))
    table = cut(_postings(t, asked))
    many = table.groupBy("size", "gram").agg(F.count("*").alias("n"))
    rarest = asked.join(many, ["size", "gram"], "left").groupBy("needle", "size").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("m"))
    rarest = rarest.filter("m.n > 0").select("needle", "size", "m.gram")
    return rarest.join(table, ["size", "gram"]).join(t, "id").filter(F.col("text").contains(F.col("needle"))).select("needle", "text")


def either_way(left: DataFrame, right: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(a, b, inside): pairs of distinct non-empty texts of which one holds the other; ``inside``: b holds a."""
    x, y = left.select(a).filter(f"{a} != ''").distinct(), right.select(b).filter(f"{b} != ''").distinct()
    fits = contained(x.select(F.col(a).alias("needle")), y.select(F.col(b).alias("text"))).select(F.col("needle").alias(a), F.col("text").alias(b), F.lit(True).alias("inside"))
    holds = contained(y.select(F.col(b).alias("needle")), x.select(F.col(a).alias("text"))).select(F.col("text").alias(a), F.col("needle").alias(b), F.lit(False).alias("inside"))
    return fits.unionByName(holds).groupBy(a, b).agg(F.max("inside").alias("inside"))

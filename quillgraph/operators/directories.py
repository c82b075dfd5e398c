"""Source directories: which one implements a cluster, and its source text, shortened in the middle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import trigrams
from .lineage import cut
from .ranges import before

#: What counts as source, and how much of it is kept.
EXTENSIONS = (".cpp", ".h", ".hpp", ".cc")
MOST, HEAD, TAIL = 10_000, 8_000, 2_000


def slug(name: Column) -> Column:
    """A cluster's name as a directory would have it: 'On/Off Cluster' is 'on-off'."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(F.lower(name), r"\s+cluster\s*$", ""), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def plain(directory: Column) -> Column:
    """A directory's name without hyphens and without the word for its side at the end."""
    return F.regexp_replace(F.replace(directory, F.lit("-"), F.lit("")), "(server|client)$", "")


def _shorter(a: str, b: str) -> Column:
    return F.least(F.length(a), F.length(b))


def matched(clusters: DataFrame, directories: DataFrame) -> DataFrame:
    """(cluster, path, tier): the directory of each cluster that has one.

    ``clusters``: name; ``directories``: name, path.  The first tier that finds one counts, and in it the first by name:
    1 the slug itself; 2 the slug without hyphens is the plain name, or else one holds the other, the shorter one having six
    characters and over 70% of the slug's, the longest first; 3 one begins the other, the shorter having four characters;
    4 one holds the other, likewise, the longest first; 5 tier 2 without its 70%.  Cases don't count; of directories of one
    name the first path counts.  Null names, and names whose slug is empty, match nothing; repeated names give one row.

    Equal names are joined; only clusters without one are looked up by grams.
    """
    c = clusters.select(F.col("name").alias("cluster"), slug(F.col("name")).alias("slug")).filter("slug != ''").distinct().withColumn("flat", F.replace("slug", F.lit("-"), F.lit("")))
    d = directories.select(F.lower("name").alias("dir"), "path").filter("dir != ''").groupBy("dir").agg(F.min("path").alias("path")).withColumn("plain", plain(F.col("dir")))
    c, d = cut(c), cut(d)
    first = d.filter("plain != ''").groupBy("plain").agg(F.min("dir").alias("dir"))
    same = c.join(d.select(F.col("dir").alias("slug"), F.col("dir").alias("one")), "slug", "left").join(first.withColumnsRenamed({"plain": "flat", "dir": "two"}), "flat", "left")
    same = cut(same.select("cluster", "slug", "flat", F.coalesce("one", "two").alias("dir"), F.when(F.col("one").isNotNull(), 1).when(F.col("two").isNotNull(), 2).alias("tier")))
    rest = same.filter("dir is null").select("cluster", "slug", "flat")
    flat = trigrams.either_way(rest.filter("length(flat) >= 6"), first.filter("length(plain) >= 6"), "flat", "plain").join(first, "plain")
    flat = flat.groupBy("flat").agg(F.min(F.struct(-_shorter("flat", "plain"), "dir")).alias("m")).select("flat", (-F.col("m.col1")).alias("n"), F.col("m.dir").alias("near"))
    held = trigrams.either_way(rest.filter("length(slug) >= 4"), d.filter("length(dir) >= 4"), "slug", "dir")
    begins = F.when(F.startswith("slug", "dir") | F.startswith("dir", "slug"), F.col("dir"))
    held = held.groupBy("slug").agg(F.min(begins).alias("prefix"), F.min(F.struct(-_shorter("slug", "dir"), "dir")).alias("m")).select("slug", "prefix", F.col("m.dir").alias("inside"))
    late = rest.join(flat, "flat", "left").join(held, "slug", "left")
    long = F.col("n") * 10 > F.length("slug") * 7
    tiers = F.when(long, 2).when(F.col("prefix").isNotNull(), 3).when(F.col("inside").isNotNull(), 4).when(F.col("near").isNotNull(), 5)
    late = late.select("cluster", F.when(long, F.col("near")).otherwise(F.coalesce("prefix", "inside", "near")).alias("dir"), tiers.alias("tier"))
    every = same.filter("dir is not null").select("cluster", "dir", "tier").unionByName(late.filter("dir is not null"))
    return every.join(d.select("dir", "path"), "dir").select("cluster", "path", "tier")


def source_text(files: DataFrame, most: int = MOST, head: int = HEAD, tail: int = TAIL) -> DataFrame:
    """(path, n_files, source): the source files of each directory one after the other, in the order of their names.

    ``files``: path (of the directory), name, text.  Each file follows a line with its name.  Files are taken until they
    have ``most`` characters together; what is longer than ``most`` then is its first ``head`` and last ``tail`` characters
    with a mark in between.  Files with other endings, and null names, don't count; a null text is empty; files of one name
    come in any order if their texts are alike, else by text's hash.  Directories without a source file have no row.

    What lies before a file comes from running sums over ranges, so a directory of very many files is no task's; of a file
    no more than its first ``most`` and last ``tail`` characters go on, and of a directory twice ``most`` and some.
    """
    dot = F.lower(F.regexp_extract("name", r"(?s).(\.[^.]*)$", 1))
    f = files.select("path", "name", F.coalesce("text", F.lit("")).alias("text")).filter(dot.isin(*EXTENSIONS))
    part = F.concat(F.lit("// ===== "), F.col("name"), F.lit(" =====\n"), F.col("text"))
    f = f.select("path", "name", F.xxhash64("text").alias("_h"), part.alias("part")).withColumn("_n", F.length("part"))
    f = f.select("path", "name", "_h", "_n", F.left("part", F.lit(most)).alias("left"), F.right("part", F.lit(tail)).alias("right"))
    f = before(f, ["path"], ["name", "_h"], {"_before": F.col("_n")}).filter(F.col("_before") < most)
    pieces = F.array_sort(F.collect_list(F.struct("_before", "_n", "left", "right")))
    f = f.groupBy("path").agg(pieces.alias("p"), (F.sum("_n") + 2 * (F.count("*") - 1)).alias("n"))
    joined = lambda side: F.array_join(F.col(f"p.{side}"), "\n\n")
    cut_ = F.concat(F.left(joined("left"), F.lit(head)), F.lit("\n\n// ... (truncated) ...\n\n"), F.right(joined("right"), F.lit(tail)))
    return f.select("path", F.size("p").alias("n_files"), F.when(F.col("n") <= most, joined("left")).otherwise(cut_).alias("source"))

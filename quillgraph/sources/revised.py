"""Clusters of a change-marked specification page that really changed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab as V

_FOOTER = '<div id="footer">'


def _plain(html: Column) -> Column:
    """A piece of HTML without its tags, white space as single spaces."""
    return F.trim(F.regexp_replace(F.regexp_replace(html, "<[^>]+>", " "), r"\s+", " "))


def _short(name: Column) -> Column:
    return F.replace(F.lower(name), F.lit(" cluster"), F.lit(""))


def _without_noise(html: Column) -> Column:
    """A section without changes of paragraph numbers, of numbers in contents, and of revisions and dates."""
    html = F.regexp_replace(html, "(?i)" + V.DIFF_NUMBER, "")
    html = F.regexp_replace(html, "(?i)" + V.DIFF_CONTENTS, "<a ")
    return F.regexp_replace(html, "(?i)" + V.DIFF_METADATA, "")


def cluster_sections(pages: DataFrame, id_col: str, html_col: str) -> DataFrame:
    """(id, position, cluster, names, html): a page's stretches from one cluster's heading to the next, without the footer.

    A cluster's heading is an h2 or h3 whose id begins with ``ref_`` and whose own text says "cluster"; marks around headings
    are taken off first.  ``names`` are all cluster names of the page.  Null pages and pages without such headings have no row.
    """
    html = F.substring_index(F.regexp_replace(F.regexp_replace(html_col, "(?i)" + V.DIFF_WRAP[0], "$2"), "(?i)" + V.DIFF_WRAP[1], "$1"), _FOOTER, 1)
    parts = F.filter(F.split(html, f"(?i)(?={V.CLUSTER_HEADING})", -1), lambda p: p != "")
    named = F.transform(parts, lambda p: F.struct(p.alias("html"), F.regexp_replace(_plain(F.regexp_extract(p, f"(?is)^{V.CLUSTER_HEADING}(.*?)</h[23]>", 1)), r"^\d+(?:\.\d+)*\.\s*", "").alias("name")))
    df = pages.select(F.col(id_col).alias("id"), F.explode(F.array(named)).alias("parts"))
    df = df.withColumn("starts", F.filter(F.transform("parts", lambda p, i: F.when(p["name"].rlike("(?i)cluster"), i + 1)), lambda i: i.isNotNull()))
    df = df.select("id", "parts", "starts", F.transform("starts", lambda i: F.element_at("parts", i)["name"]).alias("names"), F.posexplode("starts").alias("position", "start"))
    end = F.coalesce(F.get("starts", F.col("position") + 1), F.size("parts") + 1)
    body = F.array_join(F.transform(F.slice("parts", F.col("start"), end - F.col("start")), lambda p: p["html"]), "")
    return df.select("id", "position", F.element_at("parts", F.col("start"))["name"].alias("cluster"), "names", body.alias("html"))


def revised_clusters(pages: DataFrame, id_col: str, html_col: str, few: int = V.FEW_DIFFS) -> DataFrame:
    """(id, cluster, n_diffs): the clusters of each page with changes of their own, each name once, with the marks of its
    first such section.

    What counts are marks with attributes that are left when numbers, contents and metadata are taken off.  A section with
    fewer than ``few`` marks that name another cluster of the page (by more than three characters), and not its own, only
    holds what spilled over from a table that clusters share, and does not count.
    """
    # exploded arrays of one keep filters above them: what is matched is worked out once, not again for each filter
    df = cluster_sections(pages, id_col, html_col).select("id", "position", "cluster", "names", F.explode(F.array(_without_noise(F.col("html")))).alias("html"))
    df = df.filter(F.col("html").rlike(r"(?i)<(?:ins|del)\s"))
    df = df.select("id", "position", "cluster", "names", F.explode(F.array(F.regexp_extract_all("html", F.lit("(?is)" + V.DIFF_TEXT), 1))).alias("diffs"))
    df = df.withColumn("said", F.when(F.size("diffs").between(1, few - 1), F.lower(_plain(F.array_join("diffs", " ")))))
    own = _short(F.col("cluster"))
    other = F.exists("names", lambda n: (_short(n) != own) & (F.length(_short(n)) > 3) & F.contains(F.col("said"), _short(n)))
    spilled = F.col("said").isNotNull() & other & ~F.contains(F.col("said"), own)
    kept = df.filter(~F.coalesce(spilled, F.lit(False)))
    return kept.groupBy("id", "cluster").agg(F.min_by(F.size("diffs"), "position").cast("long").alias("n_diffs"))

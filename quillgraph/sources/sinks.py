"""Writing graphs, findings and rejected candidates: JSON, CSV, DOT, Markdown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.graph import degrees


def node_link(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(part, json): a line for each node and link, so a graph of any size is written by all tasks."""
    n = nodes.select(F.lit("node").alias("part"), F.to_json(F.struct(*nodes.columns)).alias("json"))
    e = edges.select(F.lit("link").alias("part"), F.to_json(F.struct(F.col("src").alias("source"), F.col("dst").alias("target"), *[c for c in edges.columns if c not in ("src", "dst")])).alias("json"))
    return n.unionByName(e)


def component(nodes: DataFrame, edges: DataFrame, doc_type: str) -> tuple[DataFrame, DataFrame]:
    """The nodes of a source with all edges that leave them."""
    own = nodes.filter(F.col("doc_type") == doc_type)
    return own, edges.join(own.select(F.col("node_id").alias("src")), "src", "left_semi")


def subgraph(nodes: DataFrame, edges: DataFrame, keep: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes in ``keep`` (node_id) with the edges among them."""
    ids = keep.select("node_id").distinct()
    within = edges.join(ids.withColumnRenamed("node_id", "src"), "src", "left_semi").join(ids.withColumnRenamed("node_id", "dst"), "dst", "left_semi")
    return nodes.join(ids, "node_id", "left_semi"), within.select(*edges.columns)


def _quoted(c: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('\\"')), F.lit('"'))


def dot(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(line) of a DOT graph's body."""
    n = nodes.select(F.concat(_quoted(F.col("node_id")), F.lit(" [label="), _quoted(F.left("label", F.lit(60))), F.lit("];")).alias("line"))
    e = edges.select(F.concat(_quoted(F.col("src")), F.lit(" -> "), _quoted(F.col("dst")), F.lit(" [label="), _quoted(F.col("edge_type")), F.lit("];")).alias("line"))
    return n.unionByName(e)


def node_table(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes for a CSV: degrees, edge types, how many tests their cluster has, and flags of orphans and long labels."""
    tests = nodes.filter("node_type = 'test_case'").groupBy("cluster").agg(F.count("*").alias("cluster_tests"))
    j = nodes.join(degrees(nodes, edges), "node_id").join(tests, "cluster", "left")
    return j.select("node_id", "node_type", F.left("label", F.lit(200)).alias("label"), "cluster", "doc_type", "in_degree", "out_degree", "edge_types", F.coalesce("cluster_tests", F.lit(0)).alias("cluster_tests"), ((F.col("in_degree") + F.col("out_degree")) == 0).alias("orphan"))


def edge_table(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges for a CSV with their ends' labels, types and clusters, and flags of dangling and cross-cluster ones."""
    end = lambda p: nodes.select(F.col("node_id").alias(p), *[F.col(c).alias(f"{p}_{c}") for c in ("label", "node_type", "cluster")])
    j = edges.join(end("src"), "src", "left").join(end("dst"), "dst", "left")
    lost = F.col("src_node_type").isNull() | F.col("dst_node_type").isNull()
    cross = F.coalesce((F.col("src_cluster") != F.col("dst_cluster")) & (F.col("src_cluster") != "") & (F.col("dst_cluster") != ""), F.lit(False))
    return j.select("src", "edge_type", "dst", "src_label", "src_node_type", "src_cluster", "dst_label", "dst_node_type", "dst_cluster", lost.alias("dangling"), cross.alias("cross_cluster"))


def health(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(what, kind, n): counts of nodes and edges by type, and of orphans and dangling edges."""
    n, e = node_table(nodes, edges), edge_table(nodes, edges)
    count = F.count("*").alias("n")
    parts = [n.groupBy(F.lit("node").alias("what"), F.col("node_type").alias("kind")).agg(count), e.groupBy(F.lit("edge").alias("what"), F.col("edge_type").alias("kind")).agg(count)]
    parts += [n.filter("orphan").groupBy(F.lit("orphan").alias("what"), F.col("node_type").alias("kind")).agg(count), e.filter("dangling").groupBy(F.lit("dangling").alias("what"), F.col("edge_type").alias("kind")).agg(count)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def save_graph(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """Both tables as Parquet below ``path``."""
    nodes.write.mode("overwrite").parquet(f"{path}/nodes")
    edges.write.mode("overwrite").parquet(f"{path}/edges")


def write_csv(df: DataFrame, path: str) -> None:
    flat = [F.array_join(f.name, "|").alias(f.name) if f.dataType.typeName() == "array" else F.to_json(f.name).alias(f.name) if f.dataType.typeName() in ("map", "struct") else F.col(f.name) for f in df.schema]
    df.select(*flat).write.mode("overwrite").option("header", True).csv(path)


def markdown(df: DataFrame, group: str, columns: list[str]) -> DataFrame:
    """(group, text): a section with a table for each group, rows in their order."""
    row = F.concat(F.lit("| "), F.concat_ws(" | ", *[F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("|"), F.lit("\\|")) for c in columns]), F.lit(" |"))
    head = "| " + " | ".join(columns) + " |\n|" + "-|" * len(columns) + "\n"
    lines = df.groupBy(group).agg(F.array_join(F.array_sort(F.collect_list(row)), "\n").alias("t"))
    return lines.select(group, F.concat(F.lit("## "), F.col(group).cast("string"), F.lit("\n\n" + head), "t").alias("text"))

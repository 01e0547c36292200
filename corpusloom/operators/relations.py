"""Knowledge-graph operators: one hop, outgoing, in the order of the edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_named_node(node: Column) -> Column:
    """False for 64 lower-case hexadecimal digits, which stand for a document. Null gives null."""
    return ~node.rlike(r"(?d)^[0-9a-f]{64}$")


def distinct_edges(edges: DataFrame) -> DataFrame:
    """``(source, type, target, pos)``: the first of equal edges, whatever their key.

    Mentions and edges with a document at either end are dropped, and edges
    with a null end or type.
    """
    kept = edges.where((F.col("type") != "MENTIONS") & is_named_node(F.col("source")) & is_named_node(F.col("target")))
    return kept.groupBy("source", "type", "target").agg(F.min("pos").alias("pos"))


def node_relations(edges: DataFrame) -> DataFrame:
    """``(node, pos, relations, relation_count)``: targets by type, both in the order first seen.

    Two grouping steps, so that a node with a large share of the edges is first
    reduced by type. The result holds each node's distinct targets, which is
    what the operator returns.
    """
    distinct = distinct_edges(edges)
    by_type = distinct.groupBy("source", "type").agg(F.min("pos").alias("pos"), F.transform(F.array_sort(F.collect_list(F.struct("pos", "target"))), lambda x: x["target"]).alias("targets"))
    one = F.struct(F.col("pos"), F.struct(F.col("type").alias("rel_type"), F.col("targets")).alias("rel"))
    nodes = by_type.groupBy(F.col("source").alias("node")).agg(F.min("pos").alias("pos"), F.transform(F.array_sort(F.collect_list(one)), lambda x: x["rel"]).alias("relations"), F.sum(F.size("targets")).cast("int").alias("relation_count"))
    return nodes


def format_relations(relations: Column) -> Column:
    """``- TYPE: a, b`` lines."""
    return F.array_join(F.transform(relations, lambda r: F.concat(F.lit("- "), r["rel_type"], F.lit(": "), F.array_join(r["targets"], ", "))), "\n")


def first_nodes(nodes: DataFrame, n: int) -> DataFrame:
    """The first ``n`` nodes in edge order: a top-n, not a full sort."""
    return nodes.orderBy("pos").limit(n)

"""Term dictionaries and knowledge graphs: one JSON document each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.schema import GRAPH, TERM_DICTIONARY


def read_terms(spark: SparkSession, path: str) -> DataFrame:
    """``(pos, headword, brief_definition, definition, synonyms, domain, confidence)``; missing confidence is 1.0."""
    rows = spark.read.schema(TERM_DICTIONARY).option("multiLine", True).json(path)
    return rows.select(F.posexplode("terms").alias("pos", "t")).select("pos", "t.*").fillna({"confidence": 1.0})


def read_edges(spark: SparkSession, path: str) -> DataFrame:
    """``(pos, type, source, target, key)`` of the graph's edges; missing fields are empty."""
    rows = spark.read.schema(GRAPH).option("multiLine", True).json(path)
    return rows.select(F.posexplode("graph.edges").alias("pos", "e")).select("pos", "e.*").fillna("", ["type", "source", "target"])

"""Parquet tables of a folder, and the parts of them the operators share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """``folder/name.parquet``; with ``columns`` only those, so that the scan reads no others."""
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    return df.select(*columns) if columns else df


def latest(df: DataFrame, key: str, order: str = "loaded_at", tie: str = "line_no") -> DataFrame:
    """One row per ``key``: the one delivered last (then the highest ``tie``).

    ``max_by`` merges on the map side, so a key delivered any number of times
    sends one row per task. Rows with a null key are kept as they are.
    """
    rest = [c for c in df.columns if c != key]
    best = F.max_by(F.struct(*rest), F.struct(F.col(order), F.col(tie))).alias("__row")
    known = df.where(F.col(key).isNotNull()).groupBy(key).agg(best).select(key, "__row.*").select(*df.columns)
    return known.unionByName(df.where(F.col(key).isNull()))

"""JSON-lines sources and sinks.

Readers differ in what they do with a bad line, as the callers need:
``strict`` fails the job, ``lenient`` skips it and then asks for ``text``,
``merged`` keeps every JSON value. A line that holds no JSON object is skipped
by ``lenient``. All keep the physical line number, which is the order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD = "text string, id string, source string, augmentation_type string"


def raw_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``(path, line_no, value)``, lines numbered from 1 in each file.

    A file is one record here, so the numbers are those in the file whatever
    its size; use ``unnumbered`` for files of many gigabytes.
    """
    files = spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value"))
    rows = files.select("path", F.posexplode(F.split(F.regexp_replace("value", r"\r?\n\z", ""), r"\r?\n", -1)).alias("line_no", "value"))
    return rows.select("path", (F.col("line_no") + 1).alias("line_no"), "value")


def unnumbered(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``(path, line_no, value)`` of splittable files; ``line_no`` grows in file order but has gaps."""
    rows = spark.read.text(paths)
    return rows.select(F.col("_metadata.file_path").alias("path"), (F.col("_metadata.file_block_start") + F.monotonically_increasing_id() % (1 << 33)).alias("line_no"), "value")


def strict(spark: SparkSession, paths: str | list[str], schema: str | T.StructType = RECORD) -> DataFrame:
    """Every record; blank lines are skipped and a bad line fails the job."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(paths)


def parse(rows: DataFrame, schema: str = RECORD) -> DataFrame:
    """``rows`` of ``value`` with the fields of ``schema``; bad lines and lines that hold no object are dropped."""
    good = F.expr("schema_of_variant(try_parse_json(value)) like 'OBJECT%'")
    return rows.where(good).withColumn("__r", F.from_json("value", schema)).select(*[c for c in rows.columns], "__r.*")


def lenient(spark: SparkSession, paths: str | list[str], schema: str = RECORD, need_content: bool = True, max_lines: int | None = None) -> DataFrame:
    """Records that have ``text`` (and, with ``need_content``, more than the empty string).

    ``max_lines`` counts physical lines of each file, bad ones included.
    """
    rows = raw_lines(spark, paths)
    if max_lines is not None:
        rows = rows.where(F.col("line_no") <= max_lines)
    rows = parse(rows, schema).where(F.col("text").isNotNull())
    return rows.where(F.col("text") != "") if need_content else rows


def merged(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Every JSON value of every file as ``(path, line_no, value, text)``; ``text`` is null where there is none."""
    rows = raw_lines(spark, paths)
    good = F.expr("try_parse_json(value)").isNotNull()
    return rows.where(good).withColumn("text", F.get_json_object("value", "$.text"))


def write(df: DataFrame, path: str, order: str | Column | None = None, append: bool = False, by: str | None = None) -> None:
    """JSON lines at ``path``; null fields are left out.

    ``order`` sorts the whole output over range partitions, so the files read in
    name order are sorted and no single task writes everything. ``by`` makes one
    folder per value.
    """
    if order is not None:
        df = df.orderBy(order)
    writer = df.write.mode("append" if append else "overwrite")
    (writer.partitionBy(by) if by else writer).json(path)


def write_markdown(df: DataFrame, path: str, title: str, body: str = "text") -> None:
    """One Markdown text per row, headed by its ``title`` column."""
    df.select(F.concat(F.lit("# "), F.col(title), F.lit("\n\n"), F.col(body)).alias("value")).write.mode("overwrite").text(path)

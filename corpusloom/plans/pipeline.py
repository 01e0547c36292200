"""The step pipeline: one base table, one branch per step, one ordered union.

Every step reads the base rows, never another step's output. Finished steps are
phases on disk, so a run that is started again reads them back; inputs are
never changed or removed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import clean
from corpusloom.operators import dedup, generate, lexicon, merge, quality

Step = Callable[[DataFrame], DataFrame]


def steps(terms: DataFrame | None, edges: DataFrame | None, generator: generate.Generator = generate.echo) -> dict[str, Step]:
    """The steps that the inputs allow; dictionary steps need terms, the graph step needs edges."""

    def keyworded(df: DataFrame) -> DataFrame:
        words = lexicon.extract_keywords(df, terms, "pos")
        return words.select("pos", lexicon.render_keywords(F.col("keywords")).alias("text"), F.lit("keywords").alias("source"))

    def questions(df: DataFrame) -> DataFrame:
        found = lexicon.find_terms(df, terms, "pos").groupBy("pos").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", F.struct("entry.headword", "entry.brief_definition").alias("t")))), lambda x: x["t"]).alias("terms"))
        return generate.difficult_questions(df.join(found, "pos"), generator).select("pos", "text", F.lit("qa").alias("source"))

    out: dict[str, Step] = {"english": lambda df: generate.to_english(df, generator).select("pos", "text", "source")}
    if terms is not None:
        out |= {
            "dictionary": lambda df: lexicon.definition_texts(terms),
            "elaboration": lambda df: lexicon.elaborate(df, terms).select("pos", "text", F.lit("elaboration").alias("source")),
            "generalized": lambda df: lexicon.generalize(df, terms).select("pos", "text", F.lit("generalized").alias("source")),
            "keywords": keyworded,
            "qa": questions,
        }
    if edges is not None:
        out["graph"] = lambda df: generate.relation_texts(edges, generator).select("pos", "text", "source", "node", "relation_count")
    return out


def run(base: DataFrame, asked: str, available: dict[str, Step], folder: str | None = None) -> DataFrame:
    """Base rows and the rows of each step asked for, with ``step_rank`` and ``pos`` as their order.

    With ``folder`` each step is written there once and read back on a later run.
    """
    spark = base.sparkSession
    parts = [merge.default_source(base if "source" in base.columns else base.withColumn("source", F.lit(None).cast("string")))]
    for name in merge.parse_steps(asked):
        if name in available:
            part = available[name](base)
            parts.append(phase(spark, part, folder, name) if folder else part)
    return merge.union_in_order(parts)


def phase(spark: SparkSession, df: DataFrame, folder: str, name: str) -> DataFrame:
    """``df`` as the finished phase ``name`` under ``folder``: read if its success mark is there, else written."""
    path = f"{folder}/phase={name}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS")
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def quality_rows(df: DataFrame, order: str, scorer: quality.Scorer | None = None) -> DataFrame:
    """Rows that are safe, not near duplicates of earlier safe rows, and below the perplexity bound, in that order."""
    safe = df.where(quality.is_safe(F.col("text")))
    flags = dedup.near_duplicates(safe, order)
    kept = safe.join(flags.where(~F.col("duplicate")), order, "left_semi")
    return quality.filter_perplexity(kept, scorer) if scorer else kept


def cleaned(df: DataFrame, text: str = "text", min_chars: int = 20) -> DataFrame:
    """The cleaning job: text cleaned, fragments dropped, all other columns kept; rows without text are dropped."""
    out = clean.clean_rows(df.where(F.col(text).isNotNull()), text, "__c").withColumn(text, F.col("__c.text")).drop("__c")
    return out.where(clean.is_complete_sentence(F.col(text), min_chars))


def cleaning_report(df: DataFrame, text: str = "text") -> DataFrame:
    """One row: rows in and out and the share of characters the cleaner removed."""
    rows = clean.clean_rows(df.where(F.col(text).isNotNull()).select(text), text, "__c")
    rows = rows.select(F.length(text).alias("a"), F.length("__c.text").alias("b"), clean.is_complete_sentence(F.col("__c.text")).alias("ok"))
    kept = F.sum(F.when(F.col("ok"), F.col("b")).otherwise(0))
    return rows.agg(F.count("*").alias("rows_in"), F.count_if("ok").alias("rows_out"), (F.lit(1.0) - kept / F.greatest(F.sum("a"), F.lit(1))).alias("reduction"))

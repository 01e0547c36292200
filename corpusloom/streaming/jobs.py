"""The same operators over streams of JSON-lines files.

Row operators are the batch expressions themselves. Exact deduplication keeps
state per key within a watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusloom.functions import clean
from corpusloom.operators import pack, quality

RECORD = "id string, text string, source string, loaded_at timestamp"


def read(spark: SparkSession, folder: str, schema: str = RECORD, files_per_trigger: int = 100) -> DataFrame:
    """New files of ``folder`` as they arrive; bad lines are dropped."""
    return spark.readStream.schema(schema).option("mode", "DROPMALFORMED").option("maxFilesPerTrigger", files_per_trigger).json(folder)


def cleaned(stream: DataFrame) -> DataFrame:
    """Safe, complete, cleaned texts with their token estimate."""
    out = clean.clean_rows(stream.where(F.col("text").isNotNull()), out="__c").withColumn("text", F.col("__c.text")).drop("__c")
    out = out.where(quality.is_safe(F.col("text")) & clean.is_complete_sentence(F.col("text")))
    return out.withColumn("est_tokens", pack.estimate_tokens(F.col("text")))


def first_seen(stream: DataFrame, late: str = "3 days") -> DataFrame:
    """The first of equal texts within the watermark on ``loaded_at``; the key is a 128-bit hash."""
    keyed = stream.withColumn("text_key", F.md5("text")).withWatermark("loaded_at", late)
    return keyed.dropDuplicatesWithinWatermark(["text_key"])


def windowed_counts(stream: DataFrame, window: str = "1 day", late: str = "3 days") -> DataFrame:
    """Rows and characters by source and day."""
    day = F.window("loaded_at", window)
    return stream.withWatermark("loaded_at", late).groupBy(day.alias("day"), F.coalesce("source", F.lit("unknown")).alias("source")).agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))


def write(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Everything there is now, then stop; run again for what has come since."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).outputMode("append").start()

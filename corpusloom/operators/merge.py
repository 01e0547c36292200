"""Putting outputs together: union in order, statistics, formatting, splits and views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import rx
from corpusloom.functions.prompts import SYSTEM

#: Steps of the pipeline in the order their rows come out.
STEPS = ["extract", "dictionary", "elaboration", "generalized", "keywords", "qa", "english", "graph"]


def parse_steps(steps: str) -> list[str]:
    """``all`` or a comma list, in the fixed order of the steps; an unknown name is an error."""
    asked = STEPS if steps.strip().lower() == "all" else [s.strip() for s in steps.split(",") if s.strip()]
    unknown = [s for s in asked if s not in STEPS]
    if unknown:
        raise ValueError(f"unknown steps: {', '.join(unknown)}")
    return [s for s in STEPS if s in asked]


def union_in_order(parts: list[DataFrame]) -> DataFrame:
    """All rows with ``step_rank``, the number of the part they come from; absent fields are null."""
    out = parts[0].withColumn("step_rank", F.lit(0))
    for i, part in enumerate(parts[1:], 1):
        out = out.unionByName(part.withColumn("step_rank", F.lit(i)), allowMissingColumns=True)
    return out


def default_source(df: DataFrame) -> DataFrame:
    """A missing ``source`` is ``extract``."""
    return df.withColumn("source", F.coalesce("source", F.lit("extract")))


def source_histogram(df: DataFrame, source: str = "source") -> DataFrame:
    """``(source, n)`` sorted by source; missing is ``unknown``."""
    return df.groupBy(F.coalesce(source, F.lit("unknown")).alias("source")).agg(F.count("*").alias("n")).orderBy("source")


def merge_stats(df: DataFrame, text: str = "text") -> DataFrame:
    """One row: records, characters of those that have text, and the estimate of their tokens."""
    chars = F.coalesce(F.sum(F.length(text)), F.lit(0))
    return df.agg(F.count("*").alias("records"), chars.alias("chars"), F.floor(chars / 2).cast("long").alias("est_tokens"))


def chat_text(instruction: Column, context: Column, output: Column) -> Column:
    """An instruction example in the chat template; a blank or null context is left out."""
    asked = F.when(rx.strip(F.coalesce(context, F.lit(""))) != "", F.concat(instruction, F.lit("\n\n背景情報:\n"), context)).otherwise(instruction)
    turn = lambda role, said: F.concat(F.lit(f"<|start_header_id|>{role}<|end_header_id|>\n\n"), said, F.lit("<|eot_id|>"))
    return F.concat(F.lit("<|begin_of_text|>"), turn("system", F.lit(SYSTEM["llama3_assistant"])), turn("user", asked), turn("assistant", output))


def conversations(df: DataFrame, key: str, turn: str, role: str, content: str) -> DataFrame:
    """``(key, text)``: the turns of each conversation in the chat template, in order.

    Turns without content are left out; a conversation without a system turn
    gets the assistant's. A conversation is one training example, so its turns
    make one row.
    """
    said = F.concat(F.lit("<|start_header_id|>"), F.col(role), F.lit("<|end_header_id|>\n\n"), F.col(content), F.lit("<|eot_id|>"))
    rows = df.where(F.col(content).isNotNull() & F.col(role).isNotNull()).select(F.col(key).alias("k"), F.struct(F.col(turn).alias("t"), said.alias("s"), F.col(role).alias("r")).alias("x"))
    per = rows.groupBy("k").agg(F.array_sort(F.collect_list("x")).alias("xs"))
    system = F.concat(F.lit("<|start_header_id|>system<|end_header_id|>\n\n"), F.lit(SYSTEM["llama3_assistant"]), F.lit("<|eot_id|>"))
    opened = F.when(F.exists("xs", lambda x: x["r"] == "system"), F.lit("")).otherwise(system)
    return per.select(F.col("k").alias(key), F.concat(F.lit("<|begin_of_text|>"), opened, F.array_join(F.transform("xs", lambda x: x["s"]), "")).alias("text"))


def train_eval(df: DataFrame, key: str, share: float = 0.1, seed: int = 42, buckets: int = 4096) -> DataFrame:
    """``df`` with ``split``: exactly ``ceil(share * n)`` rows of ``eval``, the least in MD5 order of key and seed.

    The exact cut is found without sorting everything in one task: rows are
    counted by the first digits of their hash, the few rows of the bucket that
    holds the cut are ranked, all others follow from their bucket.
    """
    h = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))
    rows = df.withColumn("__h", h).withColumn("__b", F.conv(F.substring("__h", 1, 3), 16, 10).cast("int"))
    counts = {r["__b"]: r["n"] for r in rows.groupBy("__b").agg(F.count("*").alias("n")).toLocalIterator()}  # at most 4096 rows
    n = sum(counts.values())
    want = -(-int(round(share * n * 1_000_000)) // 1_000_000)
    below = 0
    border = buckets
    for b in range(buckets):
        if below + counts.get(b, 0) >= want:
            border = b
            break
        below += counts.get(b, 0)
    inside = rows.where(F.col("__b") == border).select("__h", key).orderBy("__h", key).limit(max(0, want - below)).agg(F.max(F.struct("__h", key)).alias("cut")) if want else None
    cut = inside.first()["cut"] if inside is not None else None
    if cut is None:
        evals = F.lit(False)
    else:
        evals = (F.col("__b") < border) | ((F.col("__b") == border) & ((F.col("__h") < cut["__h"]) | ((F.col("__h") == cut["__h"]) & (F.col(key) <= F.lit(cut[key])))))
    return rows.withColumn("split", F.when(evals, "eval").otherwise("train")).drop("__h", "__b")


def of_type(df: DataFrame, kind: str) -> DataFrame:
    """Rows of one ``augmentation_type``."""
    return df.where(F.col("augmentation_type") == kind)


def search(df: DataFrame, query: str) -> DataFrame:
    """Rows that hold ``query`` anywhere, in any case."""
    return df.where(F.contains(F.lower(F.to_json(F.struct(*df.columns))), F.lit(query.lower())))


def metrics(df: DataFrame, kind: str = "augmentation_type", text: str = "text") -> DataFrame:
    """One row: rows, distinct non-null types and mean text length."""
    return df.agg(F.count("*").alias("n_rows"), F.count_distinct(kind).alias("n_types"), F.avg(F.length(text)).alias("mean_chars"))


def head(df: DataFrame, order: str, n: int = 100) -> DataFrame:
    """The first ``n`` rows; ``n`` is held between 10 and 500."""
    return df.orderBy(order).limit(min(500, max(10, n)))


def record(df: DataFrame, order: str, k: int) -> DataFrame:
    """The k-th row, counted from 1: a top-k and then its last, no global window."""
    first = df.orderBy(order).limit(k)
    return first.orderBy(F.col(order).desc()).limit(1) if k >= 1 else first


def types(df: DataFrame, order: str, kind: str = "augmentation_type") -> DataFrame:
    """``(kind, first)``: distinct non-null types and the first row of each."""
    return df.where(F.col(kind).isNotNull()).groupBy(kind).agg(F.min(order).alias("first"))

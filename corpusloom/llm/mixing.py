"""Mixing sources to target shares along a training curriculum.

Each source has a weight schedule over the run, ``w(t) = share * (1 + tilt *
(2t - 1))`` for t from 0 to 1: its integral is the source's share, and the
share-weighted tilts add up to nothing, so the weights add up to one at every
moment. The tokens a source has to have given by t are ``total * share * (t +
tilt * (t^2 - t))``. A record's place in its source's shuffled order gives the
tokens before it; inverting the demand gives the moment at which those are due,
and sorting all records by that moment by range gives the training order.

The total is the largest at which no source needs more than its repeats allow,
so the shares are met by all sources that have records. A share whose source
has none can't be met; the others keep their proportions to each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.llm.tokens import DEFAULT_PATH, count_tokens
from corpusloom.session import checkpointed


def tilts(shares: dict[str, float], strength: float = 0.5) -> dict[str, float]:
    """How much each source's weight grows over the run: rising in the order of names, balanced by share."""
    names = sorted(shares)
    if len(names) < 2:
        return {n: 0.0 for n in names}
    raw = {n: 2 * i / (len(names) - 1) - 1 for i, n in enumerate(names)}
    mean = sum(shares[n] * raw[n] for n in names) / sum(shares.values())
    most = max(abs(v - mean) for v in raw.values())
    return {n: strength * (v - mean) / most for n, v in raw.items()}


def totals(counted: DataFrame, targets: DataFrame) -> DataFrame:
    """``(source, target_share, max_repeats, records, tokens)`` of the wanted sources; none gives zeros."""
    have = counted.groupBy("source").agg(F.count("*").alias("records"), F.sum("tokens").alias("tokens"))
    rows = targets.select("source", "target_share", "max_repeats").join(have, "source", "left")
    return rows.fillna(0, ["records", "tokens"])


def _in_order(df: DataFrame, partitions: int, *order: str) -> DataFrame:
    """``df`` range-partitioned and sorted, materialised, with its partition's number."""
    return checkpointed(df.repartitionByRange(partitions, *order).sortWithinPartitions(*order)).withColumn("__part", F.spark_partition_id())


def cumulative(df: DataFrame, partitions: int, seed: int = 42) -> DataFrame:
    """``(doc_id, source, tokens, before)``: the tokens of the source's records that come before, in shuffled order.

    Records are sorted by source and hash over range partitions, so a source
    with a large share of all rows is spread over many. Each partition sums its
    own run of a source; one small row per partition and source carries the
    sums on.
    """
    rows = _in_order(df.select("doc_id", "source", "tokens", F.xxhash64(F.lit(seed), "doc_id").alias("h")), partitions, "source", "h", "doc_id")
    sums = rows.groupBy("source", "__part").agg(F.sum("tokens").alias("s"))
    before = F.sum("s").over(Window.partitionBy("source").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sums.select("source", "__part", F.coalesce(before, F.lit(0)).alias("offset"))

    def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        carried: dict[str, int] = {}
        for b in batches:
            own = b.groupby("source")["tokens"].cumsum() - b["tokens"] + b["source"].map(lambda s: carried.get(s, 0))
            for s, n in b.groupby("source")["tokens"].sum().items():
                carried[s] = carried.get(s, 0) + int(n)
            yield pd.DataFrame({"doc_id": b["doc_id"], "source": b["source"], "tokens": b["tokens"], "__part": b["__part"], "own": own.astype("int64")})

    placed = rows.select("doc_id", "source", "tokens", "__part").mapInPandas(local, "doc_id long, source string, tokens long, __part int, own long")
    return placed.join(offsets, ["source", "__part"]).select("doc_id", "source", "tokens", (F.col("own") + F.col("offset")).alias("before"))


def mix(docs: DataFrame, targets: DataFrame, tokenizer: str = DEFAULT_PATH, strength: float = 0.5, seed: int = 42) -> DataFrame:
    """``(position, moment, doc_id, source, repeat, tokens)``: the training order, positions from 1.

    ``docs`` has ``doc_id, source, text``; documents of other or no sources are
    left out. ``repeat`` counts a record's uses from 1. A source gives whole
    records while they fit its demand, then the one unused record that comes
    closest to what is left, if that brings it nearer. Records without tokens are used along with
    those around them. With no tokens at all the result is empty.
    """
    wanted = targets.where(F.col("target_share") > 0)
    known = docs.join(wanted.select("source"), "source", "left_semi").select("doc_id", "source", "text")
    counted = checkpointed(count_tokens(known, tokenizer=tokenizer))
    # one row per target: the list of wanted sources is configuration, and its size is checked
    rows = totals(counted, wanted).limit(10_001).collect()
    if len(rows) > 10_000:
        raise ValueError("more than 10,000 sources in the targets")
    live = [r for r in rows if r["tokens"] > 0 and (r["max_repeats"] or 0) > 0]
    spark = docs.sparkSession
    schema = "position long, moment double, doc_id long, source string, repeat int, tokens long"
    if not live:
        return spark.createDataFrame([], schema)
    total_share = sum(r["target_share"] for r in live)
    share = {r["source"]: r["target_share"] / total_share for r in live}
    total = min(r["max_repeats"] * r["tokens"] / share[r["source"]] for r in live)
    tilt = tilts(share, strength)
    due = spark.createDataFrame(
        [(r["source"], float(total * share[r["source"]]), int(r["tokens"]), int(r["max_repeats"]), float(tilt[r["source"]])) for r in live],
        "source string, demand double, have long, most int, tilt double",
    )
    partitions = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    placed = cumulative(counted.join(F.broadcast(due.select("source")), "source", "left_semi"), partitions, seed).join(F.broadcast(due), "source")  # due: one row per target, checked above
    rounds = F.least(F.ceil(F.col("demand") / F.col("have")).cast("int"), F.col("most"))
    uses = placed.withColumn("round", F.explode(F.sequence(F.lit(0), rounds - 1)))
    start = F.col("round") * F.col("have") + F.col("before")
    uses = uses.withColumn("start", start)
    whole = uses.where(F.col("start") + F.col("tokens") <= F.col("demand"))
    # what a source still lacks then, and the one unused record of its last round that comes closest to it
    lack = whole.groupBy("source").agg(F.sum("tokens").alias("given"))
    over = uses.where(F.col("start") + F.col("tokens") > F.col("demand")).withColumn("last", F.floor(F.col("demand") / F.col("have")).cast("int")).where(F.col("round") == F.col("last"))
    over = over.join(F.broadcast(lack), "source", "left").withColumn("rest", F.col("demand") - F.coalesce("given", F.lit(0)))  # lack: one row per target
    off = F.abs(F.col("tokens") - F.col("rest"))
    best = over.where(off < F.col("rest")).groupBy("source").agg(F.min_by(F.struct(*uses.columns), F.struct(off.alias("off"), F.col("doc_id"))).alias("u")).select("u.*")
    best = best.withColumn("start", F.least(F.col("start"), F.col("demand")))
    uses = whole.unionByName(best.select(*whole.columns))
    # total * share * (t + tilt (t^2 - t)) = start, solved for t
    due_part, b = F.col("start") / F.col("demand"), 1 - F.col("tilt")
    root = 2 * due_part / (b + F.sqrt(b * b + 4 * F.col("tilt") * due_part))
    timed = uses.select(F.least(root, F.lit(1.0)).alias("moment"), "doc_id", "source", (F.col("round") + 1).alias("repeat"), "tokens")
    ordered = _in_order(timed, partitions, "moment", "source", "repeat", "doc_id")
    sizes = ordered.groupBy("__part").agg(F.count("*").alias("n"))
    # one row per partition
    offsets, at = {}, 0
    for r in sorted(sizes.toLocalIterator(), key=lambda r: r["__part"]):
        offsets[r["__part"]], at = at, at + r["n"]

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = 0
        for b in batches:
            if len(b):
                position = offsets[int(b["__part"].iloc[0])] + seen + 1 + np.arange(len(b))
                seen += len(b)
                yield b.drop(columns="__part").assign(position=position)[["position", "moment", "doc_id", "source", "repeat", "tokens"]]

    return ordered.mapInPandas(number, schema)


def shares(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """``(source, target_share, share, tokens, uses, records, most_repeats, max_repeats)``: what was reached.

    ``share`` is of all tokens used; a source without records has 0.
    """
    used = mixed.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("uses"), F.count_if(F.col("repeat") == 1).alias("records"), F.max("repeat").alias("most_repeats"))
    rows = targets.select("source", "target_share", "max_repeats").join(used, "source", "left").fillna(0, ["tokens", "uses", "records", "most_repeats"])
    all_tokens = rows.agg(F.sum("tokens").alias("all_tokens")).withColumn("one", F.lit(1))
    share = F.when(F.col("all_tokens") > 0, F.col("tokens") / F.col("all_tokens")).otherwise(F.lit(0.0))
    return rows.withColumn("one", F.lit(1)).join(all_tokens, "one").select("source", "target_share", share.alias("share"), "tokens", "uses", "records", "most_repeats", "max_repeats")

"""Greedy sequential packing of texts into token budgets, in parallel.

The rule is sequential: a text joins the open pack if it fits, else it opens
the next. A run of rows therefore maps the tokens carried in to those carried
out, and that map has few steps: what is carried in only decides at which row
the first new pack opens, and everything after that row is the same. Each
partition of the ordered rows is summarised by that step function, the short
list of summaries is chained, and a second pass numbers the packs. No task
holds more than its own partition, whatever the size of one group.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.session import checkpointed

SEPARATOR = "\n\n"


def estimate_tokens(text: Column) -> Column:
    """One and a half tokens a character, rounded down. Null gives null."""
    return F.floor(F.length(text).cast("long") * 3 / 2).cast("long")


def estimate_merged_tokens(chars: Column) -> Column:
    """Half a token a character, rounded down: the estimate used after merging."""
    return F.floor(chars / 2).cast("long")


def _run(tokens: list[int], limit: int, sep: int, carry: int, packs: int, at: int = 0) -> tuple[list[int], int, int]:
    """Pack numbers of ``tokens[at:]``, the tokens carried out and the packs begun; ``carry`` -1 means no open pack."""
    numbers = []
    for t in tokens[at:]:
        if t > limit:
            packs += 1
            carry = -1
            numbers.append(packs)
        elif carry >= 0 and carry + sep + t <= limit:
            carry += sep + t
            numbers.append(packs)
        else:
            packs += 1
            carry = t
            numbers.append(packs)
    return numbers, carry, packs


def _summary(tokens: list[int], limit: int, sep: int) -> list[tuple[int, int, int, bool]]:
    """Steps ``(carry from, carry out, packs begun, adds)`` of a run of rows, carries ascending from -1.

    For a carry of at least ``carry from`` (and below the next step's), the run
    ends with ``carry out`` open tokens; with ``adds`` the carry in is added to it.
    """
    n = len(tokens)
    out: list[tuple[int, int]] = [(0, 0)] * (n + 1)  # by row that opens a pack: carry out and packs begun
    for i in range(n - 1, -1, -1):
        if tokens[i] > limit:
            nxt, used = i + 1, -1
        else:
            used, nxt = tokens[i], i + 1
            while nxt < n and tokens[nxt] <= limit and used + sep + tokens[nxt] <= limit:
                used += sep + tokens[nxt]
                nxt += 1
        out[i] = (used, 1) if nxt == n else (out[nxt][0], out[nxt][1] + 1)
    steps = [(-1, *(out[0] if n else (-1, 0)), False)]
    added, fits = 0, []  # carries that reach row j and no further: limit - added(j) of them
    for j, t in enumerate(tokens):
        if t > limit:
            break
        fits.append((j, added))
        added += sep + t
    else:
        j = n
    stop = j if n else 0
    borders: list[tuple[int, int, int, bool]] = []
    if stop == n:
        if limit - added >= 0:
            borders.append((0, added, 0, True))
    elif limit - added >= 0:
        borders.append((0, *out[stop], False))
    for row, before in reversed(fits):  # the first row that doesn't fit is `row`: carries above limit - before - sep - t
        low = max(0, limit - before - sep - tokens[row] + 1)
        high = limit - before
        if low <= high:
            borders.append((low, *out[row], False))
    return steps + borders


def _apply(steps: list, carry: int) -> tuple[int, int]:
    """Carry out and packs begun for a carry in."""
    chosen = steps[0]
    for s in steps:
        if s[0] <= carry and (s[0] >= 0) == (carry >= 0):
            chosen = s
    return (carry + chosen[1] if chosen[3] else chosen[1]), chosen[2]


def pack_numbers(df: DataFrame, group: str, pos: str, tokens: str, limit: int, separator_tokens: int = 3) -> DataFrame:
    """``(group, pos, pack)``: the pack of each row, numbered from 1 within its group.

    ``pos`` orders the rows of a group and must be unique there; ``tokens`` must
    not be null. Rows above ``limit`` are packs by themselves.
    """
    kind = dict(df.dtypes)
    parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = df.select(F.col(group).alias("g"), F.col(pos).alias("p"), F.col(tokens).cast("long").alias("t"))
    rows = checkpointed(rows.repartitionByRange(parts, F.col("g").asc_nulls_first(), "p").sortWithinPartitions(F.col("g").asc_nulls_first(), "p")).withColumn("part", F.spark_partition_id())
    sep = separator_tokens

    def runs(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[object, int, list, list[int]]]:
        now, part, ps, ts = None, -1, [], []
        for b in batches:
            for g, p, t, k in zip(b["g"], b["p"], b["t"], b["part"], strict=True):
                if part >= 0 and g != now and not (pd.isna(g) and pd.isna(now)):
                    yield now, part, ps, ts
                    ps, ts = [], []
                now, part = g, int(k)
                ps.append(p)
                ts.append(int(t))
        if part >= 0:
            yield now, part, ps, ts

    def summarise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g, part, _, ts in runs(batches):
            steps = _summary(ts, limit, sep)
            yield pd.DataFrame({"g": [g], "part": [part], "steps": [[{"a": a, "b": b, "c": c, "d": d} for a, b, c, d in steps]]})

    summaries = rows.mapInPandas(summarise, f"g {kind[group]}, part int, steps array<struct<a:long,b:long,c:long,d:boolean>>")

    def chain(b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values("part")
        carry, packs, out = -1, 0, []
        for g, part, steps in zip(b["g"], b["part"], b["steps"], strict=True):
            out.append((g, part, carry, packs))
            carry, more = _apply([(s["a"], s["b"], s["c"], s["d"]) for s in steps], carry)
            packs += more
        return pd.DataFrame(out, columns=["g", "part", "carry", "packs"])

    # one row per partition that a group spans, so a group's summaries number at most the partitions
    starts = summaries.groupBy("g").applyInPandas(chain, f"g {kind[group]}, part int, carry long, packs long").where("packs > 0 or carry >= 0")
    # a partition's first group is the only one that can begin earlier: one start per partition, bounded by their number
    start_of = {r["part"]: (r["carry"], r["packs"]) for r in starts.select("part", "carry", "packs").toLocalIterator()}

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for k, (g, part, ps, ts) in enumerate(runs(batches)):
            carry, packs = start_of.get(part, (-1, 0)) if k == 0 else (-1, 0)
            numbers, _, _ = _run(ts, limit, sep, carry, packs)
            yield pd.DataFrame({group: [g] * len(ps), pos: ps, "pack": numbers})

    return rows.mapInPandas(number, f"`{group}` {kind[group]}, `{pos}` {kind[pos]}, pack long")


def pack(df: DataFrame, group: str, pos: str, text: str = "text", limit: int = 2048) -> DataFrame:
    """``(group, pack, text, n, tokens)``: the texts of each pack joined by a blank line.

    Null and empty texts are left out, as the reader does. A pack's texts fit
    the limit or it is a single text, so no row grows with its group.
    """
    rows = df.where(F.coalesce(F.col(text), F.lit("")) != "").withColumn("__t", estimate_tokens(F.col(text)))
    numbers = pack_numbers(rows, group, pos, "__t", limit)
    same = [rows[pos].eqNullSafe(numbers[pos]), rows[group].eqNullSafe(numbers[group])]
    joined = rows.join(numbers, same).select(rows[group].alias(group), "pack", rows[pos].alias("p"), F.col(text).alias("x"), "__t")
    parts = F.transform(F.array_sort(F.collect_list(F.struct("p", "x"))), lambda r: r["x"])
    return joined.groupBy(group, "pack").agg(F.array_join(parts, SEPARATOR).alias("text"), F.count("*").alias("n"), (F.sum("__t") + 3 * (F.count("*") - 1)).alias("tokens"))


def pack_stats(df: DataFrame, packs: DataFrame) -> DataFrame:
    """One row: texts before, packs after, their ratio and the mean tokens of a pack; null ratios on empty input."""
    before = df.where(F.coalesce("text", F.lit("")) != "").agg(F.count("*").alias("texts")).withColumn("one", F.lit(1))
    after = packs.agg(F.count("*").alias("packs"), F.avg("tokens").alias("mean_tokens")).withColumn("one", F.lit(1))
    return before.join(after, "one").drop("one").withColumn("ratio", F.when(F.col("packs") > 0, F.col("texts") / F.col("packs")))


def shuffled(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """Rows in a random order that depends only on ``key`` and ``seed``."""
    return df.orderBy(F.xxhash64(F.lit(seed), F.col(key)), key)

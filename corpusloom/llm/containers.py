"""Filling fixed-capacity containers with items, by minimum bin slack.

Only the lengths matter, so the plan is made on their histogram: at most
``capacity`` entries, however many documents there are. Each step fixes the
longest remaining length and finds, by subset-sum dynamic programming on a
bitset, the multiset of remaining lengths that comes closest to the capacity;
the counts are traced back and the pattern is used as often as the histogram
allows. Each use leaves at least one length with fewer items than the pattern
needs, so the number of patterns is bounded by the capacity too. Documents are
then matched to the plan by their rank among those of equal length, which is
counted partition by partition.
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

#: ``(first container, times used, ((length, how many), ...))``
Pattern = tuple[int, int, tuple[tuple[int, int], ...]]


def closest(counts: dict[int, int], room: int) -> list[tuple[int, int]]:
    """The multiset of lengths with the largest sum up to ``room``, as ``(length, how many)``.

    Bit s of ``reach`` says that some multiset sums to s. Counts are split in
    powers of two, so each length takes a few shifts; the bitset before each
    shift is kept to trace the counts back. Longer lengths come first and the
    search ends as soon as the room is filled exactly.
    """
    full = (1 << (room + 1)) - 1
    reach, trail = 1, []
    for length in sorted((x for x in counts if 0 < x <= room), reverse=True):
        left, part = min(counts[length], room // length), 1
        while left > 0:
            take = min(part, left)
            trail.append((length, take, reach))
            reach |= (reach << (length * take)) & full
            left -= take
            part *= 2
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    used: dict[int, int] = {}
    for length, take, before in reversed(trail):
        if not before >> total & 1:  # the sum needs this part
            used[length] = used.get(length, 0) + take
            total -= length * take
    return sorted(used.items(), reverse=True)


def plan(histogram: dict[int, int], capacity: int) -> list[Pattern]:
    """Patterns that use up the histogram of lengths from 1 to ``capacity``."""
    left = {length: n for length, n in histogram.items() if n > 0 and 0 < length <= capacity}
    out: list[Pattern] = []
    container = 0
    for seed in sorted(left, reverse=True):
        while left.get(seed, 0) > 0:
            left[seed] -= 1
            need = dict(closest(left, capacity - seed))
            left[seed] += 1
            need[seed] = need.get(seed, 0) + 1
            times = min(left[length] // n for length, n in need.items())
            for length, n in need.items():
                left[length] -= n * times
                if not left[length]:
                    del left[length]
            out.append((container, times, tuple(sorted(need.items(), reverse=True))))
            container += times
    return out


def _ranges(patterns: list[Pattern]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """By length: first rank, items per container and first container of each pattern that uses it."""
    rows: dict[int, list[tuple[int, int, int]]] = {}
    used: dict[int, int] = {}
    for first, times, need in patterns:
        for length, n in need:
            rows.setdefault(length, []).append((used.get(length, 0), n, first))
            used[length] = used.get(length, 0) + n * times
    return {length: tuple(np.array(c, dtype=np.int64) for c in zip(*r, strict=True)) for length, r in rows.items()}


def ranked(df: DataFrame, group: str) -> DataFrame:
    """``df`` with ``rank``, from 0, among rows of equal ``group``; any order, but each rank once.

    ``df`` must be checkpointed: both passes have to see the same partitions. A
    group of any size is counted in every partition by itself; what is shuffled
    is a count per partition and group, and the rows themselves only to meet
    their partition's offset.
    """
    names = df.columns
    parts = df.withColumn("__part", F.spark_partition_id())
    counts = parts.groupBy(group, "__part").agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(group, "__part", F.coalesce(before, F.lit(0)).alias("__offset"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)

    def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[object, int] = {}
        for b in batches:
            at = b.groupby(group, dropna=False).cumcount().to_numpy() + b[group].map(lambda g: seen.get(g, 0)).to_numpy(dtype=np.int64)
            for g, n in b[group].value_counts(dropna=False).items():
                seen[g] = seen.get(g, 0) + int(n)
            yield b.assign(__local=at)

    placed = parts.mapInPandas(local, f"{fields}, __part int, __local long")
    return placed.join(offsets, [group, "__part"]).select(*names, (F.col("__local") + F.col("__offset")).alias("rank"))


def items(df: DataFrame, capacity: int, key: str) -> DataFrame:
    """``(key, piece, first, size)``: one item per document, or full pieces and a rest for those over the capacity."""
    pieces = F.greatest(F.ceil(F.col("tokens") / capacity).cast("int"), F.lit(1))
    rows = df.select(key, "tokens", F.posexplode(F.sequence(F.lit(1), pieces)).alias("i", "piece"))
    first = F.col("i").cast("long") * capacity
    return rows.select(key, "piece", first.alias("first"), F.least(F.col("tokens") - first, F.lit(capacity)).alias("size"))


def fill(df: DataFrame, capacity: int = 2048, key: str = "doc_id", text: str = "text", tokenizer: str = DEFAULT_PATH) -> DataFrame:
    """``(container, key, piece, first, size)``: the container, from 1, of every document or piece of one.

    ``first`` and ``size`` say which tokens of the document a piece holds.
    Only documents over the capacity have more than one piece. Documents
    without tokens (null or empty text) take no room and are spread over the
    containers; if there is no container at all they come out in container 1.
    """
    counted = count_tokens(df.select(key, text), text, tokenizer)
    sized = checkpointed(items(counted, capacity, key))
    # one entry per length, so at most capacity + 1 of them
    histogram = {int(r["size"]): int(r["n"]) for r in sized.groupBy("size").agg(F.count("*").alias("n")).toLocalIterator()}
    patterns = plan(histogram, capacity)
    ranges = _ranges(patterns)
    containers = max(1, sum(times for _, times, _ in patterns))

    @F.pandas_udf("long")
    def container(size: pd.Series, rank: pd.Series) -> pd.Series:
        out = (rank % containers).to_numpy(dtype=np.int64).copy()
        for length, at in size.groupby(size).groups.items():
            if length > 0:
                first, per, base = ranges[int(length)]
                r = rank.loc[at].to_numpy(dtype=np.int64)
                k = np.searchsorted(first, r, side="right") - 1
                out[size.index.get_indexer(at)] = base[k] + (r - first[k]) // per[k]
        return pd.Series(out + 1, index=size.index)

    return ranked(sized, "size").select(container("size", "rank").alias("container"), key, "piece", "first", "size")


def filled(assigned: DataFrame, capacity: int = 2048, key: str = "doc_id") -> DataFrame:
    """``(container, n_items, fill, room, documents)``: what each container holds.

    A container holds at most ``capacity`` items with tokens, so a row's size
    is bounded; ``documents`` lists key, piece, first token and size.
    """
    what = F.struct(key, "piece", "first", "size")
    rows = assigned.groupBy("container").agg(F.count("*").cast("int").alias("n_items"), F.sum("size").alias("fill"), F.array_sort(F.collect_list(what)).alias("documents"))
    return rows.select("container", "n_items", "fill", (F.lit(capacity) - F.col("fill")).alias("room"), "documents")

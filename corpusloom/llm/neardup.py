"""Near-duplicate texts: a multi-index Hamming join over MinHash signatures.

A signature is ``chunks * width`` symbols, each the least of one hash over the
text's character sequences; two texts agree on a symbol with the probability of
their similarity. It is split into ``chunks`` parts. If two signatures differ
in at most ``2 * chunks - 1`` symbols, some part has at most one error
(pigeonhole), so each part is indexed once per position that may be wrong, with
that symbol left out: every pair within the signature distance meets in a
bucket. Pairs met are held against the signature distance, then against the
texts themselves, so the result has no false pair.

Equal texts are one class from the start and never meet each other: a class of
any size is one row in the join. Texts are only moved for classes that take
part in a pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import checkpointed

CHUNKS, WIDTH = 10, 6
#: Classes in a bucket that one task joins with each other; a larger bucket is joined in parts of this size.
HOT = 2_000
#: Ids whose texts are fetched by a broadcast semi-join; more are fetched by a shuffle join.
BROADCAST_IDS = 1_000_000
_WHITE = np.array([c for c in range(0x110000) if chr(c).isspace()], dtype=np.uint32)


def _codes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all rows without white space, and the bounds of the rows."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]] if len(column) and offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])[offsets - offsets[0]]
    codes = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), dtype="<u4")
    white = np.zeros(0x3001, dtype=bool)
    white[_WHITE] = True
    keep = ~((codes < 0x3001) & white[np.minimum(codes, 0x3000)])
    return codes[keep], np.concatenate([[0], np.cumsum(keep)])[chars]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


def _sequences(codes: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of each run of ``n`` code points; 21 bits each for the first three, the rest folded in."""
    with np.errstate(over="ignore"):
        out = np.zeros(max(0, len(codes) - n + 1), dtype=np.uint64)
        for i in range(n):
            out = out * np.uint64(0x9E3779B97F4A7C15) + codes[i : len(out) + i].astype(np.uint64) + np.uint64(1)
        return _mix(out)


def signatures(column: pa.Array, n: int = 5, symbols: int = CHUNKS * WIDTH) -> np.ndarray:
    """A row of ``symbols`` 16-bit symbols per text; texts shorter than one sequence count as one sequence.

    Each symbol is the top of the least of one random linear hash over all of
    the text's sequences, taken for the whole batch at once.
    """
    codes, bounds = _codes(column)
    rows = len(column)
    out = np.zeros((rows, symbols), dtype=np.int32)
    short = np.diff(bounds) < n
    hashes = _sequences(codes, n)
    top = (hashes >> np.uint64(32)).astype(np.uint32)
    start = np.minimum(bounds[:-1], max(0, len(top) - 1))
    inside = np.ones(len(top), dtype=bool)  # a run that crosses into the next row
    for k in range(1, n):
        cross = bounds[1:-1] - k
        inside[cross[(cross >= 0) & (cross < len(top))]] = False
    rng = np.random.default_rng(20240229)
    factors = rng.integers(0, 2**31, symbols, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    shifts = rng.integers(0, 2**32, symbols, dtype=np.uint32)
    if len(top):
        with np.errstate(over="ignore"):
            for j in range(symbols):
                h = top * factors[j] + shifts[j]
                h ^= h >> np.uint32(15)
                h *= np.uint32(0x2C1B3C6D)
                h[~inside] = 0xFFFFFFFF
                least = np.minimum.reduceat(h, start)
                out[:, j] = least >> np.uint32(16)
    for r in np.flatnonzero(short):
        part = codes[bounds[r] : bounds[r + 1]]
        out[r] = int(_mix(np.frombuffer(blake2b(part.tobytes(), digest_size=8).digest(), dtype="<u8").copy())[0] >> np.uint64(48))
    return out


def similarity(a: str, b: str, n: int = 5) -> float:
    """Distinct character sequences in both over those in either, white space removed; exact."""
    sets = []
    for x in (a, b):
        x = "".join(x.split())
        sets.append({x[i : i + n] for i in range(max(1, len(x) - n + 1))})
    common = len(sets[0] & sets[1])
    return common / (len(sets[0]) + len(sets[1]) - common)


def text_classes(df: DataFrame, key: str, text: str, min_chars: int) -> DataFrame:
    """``(hid, h2, key)``: the class of equal texts of each row that is long enough.

    The class is a 64-bit hash with a second, 32-bit one; joins go by the
    first, and whatever meets is checked on the texts.
    """
    rows = df.where((F.length(text) >= min_chars) & F.col(key).isNotNull())
    return rows.select(F.xxhash64(text).alias("hid"), F.hash(text).alias("h2"), F.col(key).alias("key"))


def _signed(df: DataFrame, text: str, min_chars: int, n: int) -> DataFrame:
    """``(hid, sig)``: one signature per class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sig = signatures(batch.column(1), n)
                flat = pa.array(sig.reshape(-1).astype(np.int16))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, sig.size + 1, sig.shape[1], dtype=np.int32)), flat)
                yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["hid", "sig"])

    rows = df.where(F.length(text) >= min_chars).select(F.xxhash64(text).alias("hid"), F.col(text).alias("x"))
    # equal texts have equal signatures, so any of them will do; the aggregate merges copies on the map side
    return rows.mapInArrow(run, "hid long, sig array<short>").groupBy("hid").agg(F.first("sig").alias("sig"))


def _candidates(signed: DataFrame, chunks: int, width: int, distance: int) -> DataFrame:
    """``(a, b)`` with ``a < b``: classes within ``distance`` symbols, by the multi-index join."""
    keys = [
        F.xxhash64(F.lit(c * width + out), *[F.get("sig", F.lit(c * width + i)) for i in range(width) if i != out])
        for c in range(chunks)
        for out in range(width)
    ]
    index = signed.select("hid", F.explode(F.array(*keys)).alias("k"))
    # one shuffle by bucket serves for counting and joining; buckets of one go no further
    index = index.withColumn("n", F.count("*").over(Window.partitionBy("k"))).where("n > 1")
    cold = index.where(F.col("n") <= HOT)
    met = cold.alias("a").join(cold.alias("b"), F.col("a.k") == F.col("b.k")).where(F.col("a.hid") < F.col("b.hid")).select(F.col("a.hid").alias("a"), F.col("b.hid").alias("b"))
    # a larger bucket is a square of cells, each of which joins one part of it with another
    parts = F.ceil(F.col("n") / HOT).cast("int")
    hot = index.where(F.col("n") > HOT).select("hid", "k", parts.alias("s"), F.pmod(F.xxhash64("hid"), parts).cast("int").alias("own"))
    every = F.explode(F.sequence(F.lit(0), F.col("s") - 1))
    left, right = hot.select(F.col("hid").alias("a"), "k", F.col("own").alias("i"), every.alias("j")), hot.select(F.col("hid").alias("b"), "k", every.alias("i"), F.col("own").alias("j"))
    salted = left.join(right.hint("shuffle_merge"), ["k", "i", "j"]).where(F.col("a") < F.col("b")).select("a", "b")
    pairs = met.union(salted).distinct()
    sa, sb = signed.select(F.col("hid").alias("a"), F.col("sig").alias("sa")), signed.select(F.col("hid").alias("b"), F.col("sig").alias("sb"))
    wrong = F.aggregate(F.zip_with("sa", "sb", lambda x, y: (x != y).cast("int")), F.lit(0), lambda s, x: s + x)
    return pairs.join(sa, "a").join(sb, "b").where(wrong <= distance).select("a", "b")


def similar_classes(df: DataFrame, threshold: float, text: str = "text", min_chars: int = 200, n: int = 5, chunks: int = CHUNKS, width: int = WIDTH) -> DataFrame:
    """``(a, a2, b, b2, similarity)``: pairs of different texts at or above ``threshold``.

    The signature distance allowed is that of the threshold with a margin of
    four standard deviations, so the distance test loses next to nothing; what
    the index guarantees is ``2 * chunks - 1`` symbols, and beyond that a pair
    is missed only if no part has fewer than two errors.
    """
    symbols = chunks * width
    margin = 4 * (symbols * threshold * (1 - threshold)) ** 0.5
    distance = int(symbols * (1 - threshold) + margin)
    signed = checkpointed(_signed(df, text, min_chars, n))
    pairs = checkpointed(_candidates(signed, chunks, width, distance))
    ids = checkpointed(pairs.select(F.col("a").alias("hid")).union(pairs.select("b")).distinct())
    small = ids.count() <= BROADCAST_IDS  # 8 bytes each
    rows = df.where(F.length(text) >= min_chars).select(F.xxhash64(text).alias("hid"), F.hash(text).alias("h2"), F.col(text).alias("x"))
    texts = rows.join(F.broadcast(ids) if small else ids, "hid", "left_semi").groupBy("hid", "h2").agg(F.first("x").alias("x"))
    texts = checkpointed(texts)
    # different texts of one hash value are a pair too
    same = texts.groupBy("hid").agg(F.count("*").alias("c")).where("c > 1").select(F.col("hid").alias("a"), F.col("hid").alias("b"))
    ta = texts.select(F.col("hid").alias("a"), F.col("h2").alias("a2"), F.col("x").alias("xa"))
    tb = texts.select(F.col("hid").alias("b"), F.col("h2").alias("b2"), F.col("x").alias("xb"))
    both = pairs.union(same).join(ta, "a").join(tb, "b").where((F.col("a") != F.col("b")) | (F.col("a2") < F.col("b2")))

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            s = [similarity(x, y, n) for x, y in zip(b["xa"], b["xb"], strict=True)]
            yield b[["a", "a2", "b", "b2"]].assign(similarity=np.array(s, dtype=float))

    return both.mapInPandas(verify, "a long, a2 int, b long, b2 int, similarity double").where(F.col("similarity") >= threshold)


def pairs(df: DataFrame, threshold: float = 0.7, key: str = "id", text: str = "text", min_chars: int = 200, n: int = 5) -> DataFrame:
    """``(id_a, id_b)`` with ``id_a < id_b`` of different ids at or above the threshold; equal texts count.

    Short and null texts and null ids take no part. Rows delivered again make
    no new pair.
    """
    members = checkpointed(text_classes(df, key, text, min_chars).distinct())
    found = similar_classes(df, threshold, text, min_chars, n)
    a, b = members.select(F.col("hid").alias("a"), F.col("h2").alias("a2"), F.col("key").alias("x")), members.select(F.col("hid").alias("b"), F.col("h2").alias("b2"), F.col("key").alias("y"))
    across = found.join(a, ["a", "a2"]).join(b, ["b", "b2"]).select("x", "y")
    within = a.join(b, (F.col("a") == F.col("b")) & (F.col("a2") == F.col("b2")) & (F.col("x") < F.col("y"))).select("x", "y")
    both = across.union(within).where(F.col("x") != F.col("y"))
    return both.select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b")).distinct()


def groups(df: DataFrame, threshold: float = 0.7, key: str = "id", text: str = "text", min_chars: int = 200, n: int = 5) -> DataFrame:
    """``(key, class, group, copies, links)`` of every row that is long enough, once per key.

    ``class`` is the least key with an equal text and ``copies`` how many keys
    have it; ``links`` counts the other classes linked to it; ``group`` is the
    least key among all classes connected by links. Groups come from rounds
    in which each class takes the least label around it and then its label's
    label, so their number grows with the logarithm of a chain's length; each
    round is checkpointed and nothing is collected.
    """
    members = checkpointed(text_classes(df, key, text, min_chars).distinct())
    classes = members.groupBy("hid", "h2").agg(F.min("key").alias("class"), F.count("*").alias("copies"))
    found = similar_classes(df, threshold, text, min_chars, n)
    name = classes.select("hid", "h2", "class")
    linked = found.join(name.select(F.col("hid").alias("a"), F.col("h2").alias("a2"), F.col("class").alias("u")), ["a", "a2"]).join(name.select(F.col("hid").alias("b"), F.col("h2").alias("b2"), F.col("class").alias("v")), ["b", "b2"])
    edges = checkpointed(linked.select("u", "v").union(linked.select("v", "u")).distinct())
    label = checkpointed(edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("l")))
    while True:
        around = edges.join(label.select(F.col("u").alias("v"), F.col("l").alias("lv")), "v").groupBy("u").agg(F.min("lv").alias("lv"))
        step = label.join(around, "u").select("u", F.least("l", "lv").alias("l"), F.col("l").alias("old"))
        up = step.select(F.col("u").alias("l"), F.col("l").alias("ll"))
        nxt = checkpointed(step.join(up, "l", "left").select("u", F.least("l", F.coalesce("ll", "l")).alias("l"), "old"))
        moved = nxt.where(F.col("l") != F.col("old")).limit(1).count()
        label = nxt.select("u", "l")
        if not moved:
            break
    degree = edges.groupBy("u").agg(F.count("*").alias("links"))
    about = classes.join(label.select(F.col("u").alias("class"), "l"), "class", "left").join(degree.select(F.col("u").alias("class"), "links"), "class", "left")
    about = about.select("hid", "h2", "class", F.coalesce("l", "class").alias("group"), "copies", F.coalesce("links", F.lit(0)).alias("links"))
    return members.join(about, ["hid", "h2"]).select(F.col("key").alias(key), "class", "group", "copies", "links")

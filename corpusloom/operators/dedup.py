"""Exact and near duplicates, first row wins.

Near duplicates are rows whose sets of white-space words have a Jaccard
similarity above a bound. Pairs come from an exact prefix-filter join: with the
words of each set ordered from rare to common, two sets above the bound share a
word among the first ``n - ceil(bound * n) + 1`` of both. Equal sets are folded
into one before, so copies never meet each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusloom.functions import rx
from corpusloom.session import checkpointed


def first_of_equal(df: DataFrame, key: Column, order: str) -> DataFrame:
    """The first row, by ``order``, of those with equal ``key``; null keys count as equal.

    ``min_by`` merges on the map side, so one very common key costs one row per task.
    """
    best = df.groupBy(key.alias("__key")).agg(F.min_by(F.struct(*df.columns), order).alias("__row"))
    return best.select("__row.*")


def words(text: Column) -> Column:
    """Distinct white-space words, sorted; blank and null texts have none."""
    bare = rx.strip(F.coalesce(text, F.lit("")))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.array_sort(F.array_distinct(F.split(bare, r"(?U)\s+"))))


def word_classes(df: DataFrame, order: str, text: str) -> DataFrame:
    """``(cid, words)``: one row per distinct set of words; ``cid`` is the least ``order`` that has it."""
    rows = df.select(F.col(order).alias("o"), words(F.col(text)).alias("words")).where(F.size("words") > 0)
    return rows.groupBy("words").agg(F.min("o").alias("cid")).select("cid", "words")


def similar_classes(classes: DataFrame, above: float = 0.85) -> DataFrame:
    """``(a, b, similarity)`` with ``a < b`` of classes whose similarity exceeds ``above``."""
    one = classes.select("cid", F.explode("words").alias("w"))
    common = one.groupBy("w").agg(F.count("*").alias("df"))
    ranked = one.join(common, "w").groupBy("cid").agg(F.array_sort(F.collect_list(F.struct("df", "w"))).alias("ws"))
    n = F.size("ws")
    need = F.ceil(F.lit(above) * n)
    prefix = F.slice("ws", 1, (n - need + 1).cast("int"))
    keys = ranked.select("cid", n.alias("n"), F.explode(F.transform(prefix, lambda x: x["w"])).alias("w"))
    a, b = keys.alias("a"), keys.alias("b")
    near = (F.col("a.w") == F.col("b.w")) & (F.col("a.cid") < F.col("b.cid")) & (F.least("a.n", "b.n") >= F.lit(above) * F.greatest("a.n", "b.n"))
    pairs = a.join(b, near).select(F.col("a.cid").alias("a"), F.col("b.cid").alias("b")).distinct()
    wa, wb = classes.select(F.col("cid").alias("a"), F.col("words").alias("wa")), classes.select(F.col("cid").alias("b"), F.col("words").alias("wb"))
    both = pairs.join(wa, "a").join(wb, "b")
    common_words = F.size(F.array_intersect("wa", "wb"))
    similarity = common_words / (F.size("wa") + F.size("wb") - common_words)
    return both.select("a", "b", similarity.alias("similarity")).where(F.col("similarity") > above)


def first_wins(ids: DataFrame, pairs: DataFrame) -> DataFrame:
    """``(cid, kept)``: a class is kept unless an earlier kept class is linked to it.

    Works in rounds: a class without an undecided earlier link is decided. The
    number of rounds is the longest chain of links, and each round's state is
    checkpointed. Only linked classes take part; all others are kept.
    """
    linked = pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).distinct()
    state = checkpointed(linked.withColumn("kept", F.lit(None).cast("boolean")))
    pairs = checkpointed(pairs.select("a", "b"))
    while state.where(F.col("kept").isNull()).limit(1).count():
        earlier = pairs.join(state.select(F.col("cid").alias("a"), F.col("kept").alias("a_kept")), "a")
        seen = earlier.groupBy(F.col("b").alias("cid")).agg(F.max(F.coalesce("a_kept", F.lit(False))).alias("hit"), F.max(F.col("a_kept").isNull()).alias("open"))
        decided = F.when(F.coalesce("hit", F.lit(False)), False).when(~F.coalesce("open", F.lit(False)), True)
        state = checkpointed(state.join(seen, "cid", "left").select("cid", F.coalesce("kept", decided).alias("kept")))
    return ids.join(state, "cid", "left").select("cid", F.coalesce("kept", F.lit(True)).alias("kept"))


def near_duplicates(df: DataFrame, order: str, text: str = "text", above: float = 0.85) -> DataFrame:
    """``(order, duplicate)`` of every row: whether an earlier row makes it a near duplicate.

    Blank and null texts are duplicates. ``order`` must be unique and not null.
    """
    classes = checkpointed(word_classes(df, order, text))
    kept = first_wins(classes.select("cid"), similar_classes(classes, above))
    firsts = kept.where("kept").select(F.col("cid").alias(order), F.lit(False).alias("duplicate"))
    return df.select(order).join(firsts, order, "left").select(order, F.coalesce("duplicate", F.lit(True)).alias("duplicate"))


def exact_flags(df: DataFrame, key: str, order: str) -> DataFrame:
    """``df`` with ``n``, the row's number among rows of equal ``key``, by ``order``."""
    return df.withColumn("n", F.row_number().over(Window.partitionBy(key).orderBy(order)))

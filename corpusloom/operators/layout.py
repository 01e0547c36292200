"""Layout operators: cell grids, their Markdown, page furniture and column detection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions import clean, rx


def grid(row_count: Column, column_count: Column, cells: Column) -> Column:
    """Rows of cells with spans filled in; later cells overwrite earlier ones.

    A null count gives no rows; cells without an index are left out; null
    content is kept as null and null spans count as 1. Cells beyond the border
    are clipped.
    """

    def at(r: Column, c: Column) -> Column:
        def covers(x: Column) -> Column:
            rs, cs = F.coalesce(x["row_span"], F.lit(1)), F.coalesce(x["column_span"], F.lit(1))
            return (r >= x["row_index"]) & (r < x["row_index"] + rs) & (c >= x["column_index"]) & (c < x["column_index"] + cs)

        hits = F.filter(cells, lambda x: F.coalesce(covers(x), F.lit(False)))
        return F.when(F.size(hits) > 0, F.element_at(hits, -1)["content"]).otherwise("")

    def upto(n: Column) -> Column:
        return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

    full = F.transform(upto(row_count), lambda r: F.transform(upto(column_count), lambda c: at(r, c)))
    return F.when(row_count.isNotNull() & column_count.isNotNull(), full).otherwise(F.array().cast("array<array<string>>"))


def grid_markdown(rows: Column) -> Column:
    """A grid as a Markdown table, the first row as its head; no rows give the empty string."""

    def line(cells: Column) -> Column:
        return F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))

    tidy = F.transform(rows, lambda r: F.transform(r, lambda c: rx.strip(F.replace(F.coalesce(c, F.lit("")), F.lit("\n"), F.lit(" ")))))
    head = F.get(tidy, F.lit(0))
    body = F.transform(F.slice(tidy, 2, F.greatest(F.size(tidy) - 1, F.lit(0))), line)
    table = F.concat(line(head), F.lit("\n"), line(F.transform(head, lambda _: F.lit("---"))), F.lit("\n"), F.array_join(body, "\n"))
    return F.when(F.size(rows) > 0, table).otherwise("")


def combine_elements(texts: Column, tables: Column) -> Column:
    """Non-blank texts, then tables set apart, with layout spaces removed; nothing gives the empty string."""
    kept = F.filter(F.coalesce(texts, F.array().cast("array<string>")), lambda t: rx.strip(t) != "")
    shown = F.transform(F.coalesce(tables, F.array().cast("array<array<array<string>>>")), lambda t: F.concat(F.lit("\n\n"), grid_markdown(t), F.lit("\n\n")))
    return clean.strip_layout_spaces(F.array_join(F.concat(kept, shown), "\n\n"))


def drop_frequent_edges(pages: DataFrame, doc: str, page: str, text: str = "text", share: float = 0.5) -> DataFrame:
    """``(doc, page, text)`` without first and last lines that open or close at least ``share`` of a document's pages.

    Lines are counted per document as their first and last non-blank, stripped
    line, and removed where the page's very first or last line is one of them.
    Documents of fewer than three pages stay as they are. Null pages count as
    blank. Counting is partial per task, so a document with a large share of
    all pages is no hot spot; at most ``2 / share`` lines per document survive
    the threshold and are joined back.
    """
    ls = rx.lines(F.coalesce(F.col(text), F.lit("")))
    bare = F.filter(F.transform(ls, rx.strip), lambda x: x != "")
    rows = pages.select(F.col(doc).alias("d"), F.col(page).alias("p"), ls.alias("ls"), F.get(bare, F.lit(0)).alias("first"), F.when(F.size(bare) > 0, F.element_at(bare, -1)).alias("last"))
    edge = rows.select("d", F.explode(F.array(F.struct(F.lit("all").alias("side"), F.lit("").alias("line")), F.struct(F.lit("first").alias("side"), F.col("first").alias("line")), F.struct(F.lit("last").alias("side"), F.col("last").alias("line")))).alias("e"))
    counts = edge.where(F.col("e.line").isNotNull()).groupBy("d", "e").agg(F.count("*").alias("n"))
    total = counts.where("e.side = 'all'").select("d", F.col("n").alias("total"))
    often = counts.where("e.side <> 'all'").join(total, "d").where((F.col("total") >= 3) & (F.col("n") >= F.col("total") * share))
    pick = lambda side: F.collect_set(F.when(F.col("e.side") == side, F.col("e.line")))
    drop = often.groupBy("d").agg(pick("first").alias("heads"), pick("last").alias("feet"))
    hit = lambda lines, known: F.coalesce(F.array_contains(known, lines), F.lit(False))
    joined = rows.join(drop, "d", "left")
    size = F.size("ls")
    kept = F.filter("ls", lambda x, i: ~(((i == 0) & hit(rx.strip(x), F.col("heads"))) | ((i == size - 1) & hit(rx.strip(x), F.col("feet")))))
    return joined.select(F.col("d").alias(doc), F.col("p").alias(page), rx.unlines(kept).alias(text))


def is_two_column(blocks: DataFrame, page: str, x0: str, x1: str, width: str) -> DataFrame:
    """``(page, two_column)``: more than five blocks on each side of the middle, and fewer than ten apart."""
    middle, centre = F.col(width) / 2, (F.col(x0) + F.col(x1)) / 2
    left, right = F.count_if(centre < middle * 0.9), F.count_if(centre > middle * 1.1)
    return blocks.groupBy(page).agg(((left > 5) & (right > 5) & (F.abs(left - right) < 10)).alias("two_column"))

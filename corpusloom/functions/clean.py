"""Text cleaning, as column expressions.

Null text stays null through every function; empty text stays empty. All steps
but two are built-in expressions; Unicode normalisation and the contents-list
state machine are Arrow UDFs that receive null for rows they cannot change.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions import rx

# Lines of these forms hold nothing but a page number.
PAGE_NUMBER_LINES = [
    r"\s*\d{1,4}\s*$",
    r"\s*[-–—]\s*\d{1,4}\s*[-–—]\s*$",
    r"\s*\d{1,4}\s*/\s*\d{1,4}\s*$",
    r"\s*Page\s*\d+\s*$",
    r"\s*p\.\s*\d+\s*$",
    r"\s*\d+\s*ページ\s*$",
]
# Lines of these forms are heads or feet.
HEADER_FOOTER_LINES = [
    r".*技報\s*Vol\.\s*\d+.*",
    r".*\d{4}年\d{1,2}月.*発行.*",
    r"第\d+[章節条項]\s*$",
    r"\s*Copyright\s*©.*$",
    r"\s*All\s+[Rr]ights\s+[Rr]eserved.*$",
]
# What opens a contents list, and what its entries end in.
TOC_OPENERS = [r"目\s*次\s*$", r"CONTENTS\s*$", r"Table\s+of\s+Contents\s*$"]
TOC_ENTRY_ENDS = [r"\.{3,}\s*\d+\s*$", r"…+\s*\d+\s*$", r"\s+\d+\s*$"]
# A text that ends in one of these is cut off; sentence ends; brackets.
OPEN_ENDINGS = ["が", "を", "に", "で", "と", "は", "も", "へ", "や", "の", "から", "まで", "より", "ので", "ため", "けど", "けれど", "ところ"]
SENTENCE_ENDS, OPENING, CLOSING = "。．？！", "(（「『", ")）」』"
LINE_ENDS = "。．？！)）」』"
# Heading forms by level; the first that matches is used.
MAJOR_HEADINGS = [(r"(第\d+[章])\s*(.+)$", r"## \1 \2"), (r"(\d+\.)\s*(.+)$", r"## \1 \2"), (r"■\s*(.+)$", r"## \1"), (r"【(.+)】$", r"## \1")]
MINOR_HEADINGS = [(r"(第\d+[節])\s*(.+)$", r"### \1 \2"), (r"(\d+\.\d+)\s*(.+)$", r"### \1 \2"), (r"●\s*(.+)$", r"### \1"), (r"▼\s*(.+)$", r"### \1")]

#: Texts of these characters alone are their own NFKC form: none of them decomposes or combines.
_NFKC_STABLE = r"[\x00-\x7Fぁ-ゖァ-ヺー、。一-鿿]*"


@F.pandas_udf(T.StringType())
def _nfkc(text: pd.Series) -> pd.Series:
    return text.map(lambda x: unicodedata.normalize("NFKC", x), na_action="ignore")


def nfkc(text: Column) -> Column:
    """NFKC form. Texts that cannot change never leave the JVM."""
    needs = ~text.rlike(rf"\A{_NFKC_STABLE}\z")
    return F.when(needs, _nfkc(F.when(needs, text))).otherwise(text)


def _any_start(line: Column, patterns: list[str]) -> Column:
    return rx.matches_start(line, "|".join(f"(?:{p})" for p in patterns), ignore_case=True)


def drop_page_numbers(text: Column) -> Column:
    """Without lines that hold only a page number."""
    return rx.unlines(F.filter(rx.lines(text), lambda x: ~_any_start(x, PAGE_NUMBER_LINES)))


def page_number_lines(text: Column) -> Column:
    """The lines ``drop_page_numbers`` removes, in order."""
    return F.filter(rx.lines(text), lambda x: _any_start(x, PAGE_NUMBER_LINES))


def drop_headers_footers(text: Column) -> Column:
    """Without lines that have the form of a head or foot."""
    return rx.unlines(F.filter(rx.lines(text), lambda x: ~_any_start(x, HEADER_FOOTER_LINES)))


def header_footer_lines(text: Column) -> Column:
    """The lines ``drop_headers_footers`` removes, in order."""
    return F.filter(rx.lines(text), lambda x: _any_start(x, HEADER_FOOTER_LINES))


def _split_toc(text: str) -> tuple[list[str], list[str]]:
    """Lines kept and lines removed by the contents-list state machine."""
    opener = re.compile("|".join(f"(?:{p})" for p in TOC_OPENERS), re.IGNORECASE)
    entry = re.compile("|".join(f"(?:{p})" for p in TOC_ENTRY_ENDS))
    rows = text.split("\n")
    bare = [r.strip() for r in rows]
    entries = [bool(entry.search(b)) for b in bare] + [False]
    kept: list[str] = []
    removed: list[str] = []
    inside, blanks = False, 0
    for i, row in enumerate(rows):
        if not inside:
            inside = bool(opener.match(bare[i]))
            (removed if inside else kept).append(row)
        elif not bare[i]:
            blanks += 1
            if blanks == 2:
                inside, blanks = False, 0
            (removed if inside else kept).append(row)
        else:
            blanks = 0
            inside = entries[i] or (len(bare[i]) < 50 and entries[i + 1])
            (removed if inside else kept).append(row)
    return kept, removed


_TOC = T.StructType([T.StructField("text", T.StringType()), T.StructField("removed", T.ArrayType(T.StringType()))])


@F.pandas_udf(_TOC)
def _toc(text: pd.Series) -> pd.DataFrame:
    parts = [(None, []) if x is None else (lambda kr: ("\n".join(kr[0]), kr[1]))(_split_toc(x)) for x in text]
    return pd.DataFrame(parts, columns=["text", "removed"])


def split_toc(text: Column) -> Column:
    """``struct(text, removed)``: the text without its contents list, and the list's lines.

    Only rows with an opening line reach Python.
    """
    sign = text.contains("目") | text.rlike("(?i)contents")  # cheap, and every opener has one
    opens = sign & text.rlike(r"(?dUim)^\s*+(?:目\s*+次|CONTENTS|Table\s+of\s+Contents)\s*$")
    done = _toc(F.when(opens, text))
    none = F.array().cast("array<string>")
    return F.struct(F.when(opens, done["text"]).otherwise(text).alias("text"), F.when(opens, done["removed"]).otherwise(none).alias("removed"))


def repair_lines(text: Column) -> Column:
    """Lines wrapped in the middle of a sentence joined again.

    Two passes join Japanese characters across line ends. Then each line that
    is neither blank nor a ``#`` heading is stripped and joined to the one
    before unless that one ends a sentence or a bracket. Private-use characters
    mark the kind of each line meanwhile and are gone in the result.
    """
    body, body_end, other, other_end = "\ue000", "\ue001", "\ue002", "\ue003"
    joined = rx.replace_all(text, f"({rx.JP})\\n+({rx.JP})", r"\1\2")
    joined = rx.replace_all(joined, f"({rx.JP})\\n+\\s*({rx.JP})", r"\1\2")

    def mark(line: Column) -> Column:
        apart = (line["bare"] == "") | line["bare"].startswith("#")
        return F.when(apart, F.concat(F.lit(other), line["raw"], F.lit(other_end))).otherwise(F.concat(F.lit(body), line["bare"], F.lit(body_end)))

    pairs = F.transform(rx.lines(joined), lambda x: F.struct(x.alias("raw"), rx.strip(x).alias("bare")))
    marked = rx.unlines(F.transform(pairs, mark))
    glued = F.regexp_replace(marked, f"(?<![{re.escape(LINE_ENDS)}]){body_end}\n{body}", "")
    return F.translate(glued, body + body_end + other + other_end, "")


def normalize_numbers(text: Column) -> Column:
    """``1 000`` and ``1 / 2`` without their spaces; it also joins across lines."""
    return rx.replace_all(rx.replace_all(text, r"(\d)\s+(\d{3})", r"\1\2"), r"(\d)\s*/\s*(\d)", r"\1/\2")


def normalize_whitespace(text: Column) -> Column:
    """At most one blank line, no spaces at line ends, single spaces; in this order, then stripped."""
    text = F.regexp_replace(text, r"\n{3,}", "\n\n")
    text = F.regexp_replace(text, r"(?<! ) ++\n", "\n")
    return rx.strip(F.regexp_replace(text, r" {2,}", " "))


def clean_rows(
    df: DataFrame,
    text: str = "text",
    out: str = "cleaned",
    level: str = "basic",
    remove_toc: bool = True,
    remove_page_numbers: bool = True,
    unicode_form: bool = True,
    numbers: bool = True,
    line_breaks: bool = True,
) -> DataFrame:
    """``df`` with ``out``, the ``struct(text, removed_lines, stats)`` of the whole cleaner.

    Every step is a projection of its own, so that its result is computed once
    however often the next one refers to it. ``level='off'`` gives the text
    itself with no removed lines and null stats. Null text gives null text and
    null stats. An existing column ``out`` is replaced.
    """
    none = F.array().cast("array<string>")
    kept = [c for c in df.columns if c != out]
    if level == "off":
        stats = F.lit(None).cast("struct<original_chars:int,cleaned_chars:int,removed_lines:int,reduction_rate:double>")
        return df.select(*kept, F.struct(F.col(text).alias("text"), none.alias("removed_lines"), stats.alias("stats")).alias(out))
    now = df.select(*kept, (nfkc(F.col(text)) if unicode_form else F.col(text)).alias("__t"))

    def mark(line: Column) -> Column:
        page = _any_start(line, PAGE_NUMBER_LINES) if remove_page_numbers else F.lit(False)
        return F.struct(line.alias("x"), page.alias("p"), _any_start(line, HEADER_FOOTER_LINES).alias("h"))

    # one look at the whole text; line by line only where some line has one of the forms
    forms = [*(PAGE_NUMBER_LINES if remove_page_numbers else []), *HEADER_FOOTER_LINES]
    some = F.col("__t").rlike("(?dUim)^(?:" + "|".join(f"(?:{p.replace(chr(92) + 's', '[' + chr(92) + 's&&[^' + chr(92) + 'n]]')})" for p in forms) + ")")
    lines = lambda keep: F.transform(F.filter("__m", keep), lambda m: m["x"])
    now = rx.once(now, "__m", F.when(some, F.transform(rx.lines(F.col("__t")), mark)))
    gone = F.concat(lines(lambda m: m["p"]), lines(lambda m: ~m["p"] & m["h"]))
    now = now.withColumn("__gone", F.when(F.col("__m").isNotNull(), gone).otherwise(F.when(F.col("__t").isNotNull(), none))).withColumn("__t", F.when(F.col("__m").isNotNull(), rx.unlines(lines(lambda m: ~m["p"] & ~m["h"]))).otherwise(F.col("__t")))
    if remove_toc:
        now = now.withColumn("__s", split_toc(F.col("__t"))).withColumn("__gone", F.concat("__gone", "__s.removed")).withColumn("__t", F.col("__s.text"))
    if line_breaks:
        now = now.withColumn("__t", repair_lines(F.col("__t")))
    if numbers:
        now = now.withColumn("__t", normalize_numbers(F.col("__t")))
    now = rx.once(now, "__t", normalize_whitespace(F.col("__t")))
    before, after = F.length(text), F.length("__t")
    stats = F.struct(
        before.alias("original_chars"),
        after.alias("cleaned_chars"),
        F.size("__gone").alias("removed_lines"),
        (F.lit(1.0) - after / F.greatest(before, F.lit(1))).alias("reduction_rate"),
    )
    return now.select(*kept, F.struct(F.col("__t").alias("text"), F.col("__gone").alias("removed_lines"), F.when(F.col(text).isNotNull(), stats).alias("stats")).alias(out))


def clean_japanese(text: Column) -> Column:
    """Soft breaks, spaces and line ends between Japanese characters removed."""
    text = F.regexp_replace(text, "  \n", " ")
    text = strip_layout_spaces(text)
    return rx.replace_all(text, f"({rx.JP})\\n+({rx.JP})", r"\1\2")


def strip_layout_spaces(text: Column) -> Column:
    """Spaces around line ends and next to Japanese characters removed; line ends stay."""
    text = F.regexp_replace(text, " *+\n *+", "\n")
    text = rx.replace_all(text, f"(?<! ) ++({rx.JP})", r"\1")
    return rx.replace_all(text, f"({rx.JP}) ++", r"\1")


def clean_markdown(text: Column) -> Column:
    """Code marks unwrapped, lines of a paragraph joined, glued headings parted."""
    hold = "\ue000"  # private use: no text's own
    text = F.regexp_replace(text, r"(?s)```(.*?)```", "$1")
    text = F.regexp_replace(text, r"`([^`]+)`", "$1")
    text = F.replace(F.regexp_replace(text, r"\n{2,}", hold), F.lit("\n"), F.lit(" "))
    text = F.replace(text, F.lit(hold), F.lit("\n\n"))
    return rx.strip(F.regexp_replace(text, r"(?d)(#+) (.*?) (#+)", "$1 $2\n$3"))


def blank_before_headings(text: Column) -> Column:
    """A blank line before each ``#`` heading line."""
    return F.regexp_replace(text, r"\n(#+)", "\n\n$1")


def _first_form(line: Column, forms: list[tuple[str, str]]) -> Column:
    result = None
    for pattern, replacement in forms:
        hit = rx.matches_start(line, pattern)
        new = rx.replace_all(line, rf"\A(?:{pattern})", replacement)
        result = F.when(hit, new) if result is None else result.when(hit, new)
    return result.otherwise(line)


def normalize_headings(text: Column) -> Column:
    """Numbered and marked headings as ``##`` and ``###``; every line is stripped."""
    return rx.unlines(F.transform(rx.lines(text), lambda x: _first_form(_first_form(rx.strip(x), MAJOR_HEADINGS), MINOR_HEADINGS)))


def is_complete_sentence(text: Column, min_chars: int = 20) -> Column:
    """Whether the text is more than a fragment. Null counts as empty, so false for ``min_chars`` above 0."""
    text = F.coalesce(text, F.lit(""))
    size = F.length(text)
    has_end = rx.occurrences(text, SENTENCE_ENDS) > 0
    balance = F.abs(rx.occurrences(text, OPENING) - rx.occurrences(text, CLOSING)) <= 2
    cut = rx.rstrip(text).rlike("(?:" + "|".join(OPEN_ENDINGS) + r")\z")
    return (size >= min_chars) & ((size <= 100) | has_end) & balance & ~cut


def page_numbers(text: Column) -> Column:
    """All page marks ``<!-- Page n -->`` as integers, in order."""
    return F.transform(F.regexp_extract_all(text, F.lit(r"<!-- Page (\d+) -->"), 1), lambda x: x.try_cast("int"))


def page_span(text: Column) -> Column:
    """``struct(page_start, page_end)``; null where the text has no page mark."""
    pages = page_numbers(text)
    return F.struct(F.get(pages, F.lit(0)).alias("page_start"), F.when(F.size(pages) > 0, F.element_at(pages, -1)).alias("page_end"))


def substitute_figures(text: Column, descriptions: Column) -> Column:
    """The i-th ``<figure>`` replaced by the i-th ``struct(caption, description)``.

    Tags beyond the descriptions stay. Null descriptions change nothing.
    """
    tags = F.regexp_extract_all(text, F.lit(r"(?s)(<figure[^>]*>.*?</figure>)"), 1)
    rest = F.split(text, r"(?s)<figure[^>]*>.*?</figure>", -1)
    known = F.size(F.coalesce(descriptions, F.array()))

    def filled(part: Column, i: Column) -> Column:
        shown = F.concat(F.lit("\n\n【図】"), F.get(descriptions, i - 1)["caption"], F.lit("\n"), F.get(descriptions, i - 1)["description"], F.lit("\n\n"))
        return F.when(i == 0, part).otherwise(F.concat(F.when(i <= known, shown).otherwise(F.get(tags, i - 1)), part))

    return F.array_join(F.transform(rest, filled), "")


def inject_tables(text: Column, tables: Column) -> Column:
    """Each ``struct(page, number, markdown)`` put at its ``[Table p-n]`` mark, else after the page's mark."""

    def put(acc: Column, t: Column) -> Column:
        name = F.concat(t["page"].cast("string"), F.lit("-"), t["number"].cast("string"))
        mark = F.concat(F.lit("[Table "), name, F.lit("]"))
        page = F.concat(F.lit("<!-- Page "), t["page"].cast("string"), F.lit(" -->"))
        block = F.concat(page, F.lit("\n\n### 表 "), name, F.lit("\n"), t["markdown"], F.lit("\n"))
        return F.when(F.contains(acc, mark), F.replace(acc, mark, t["markdown"])).otherwise(F.replace(acc, page, block))

    return F.aggregate(F.coalesce(tables, F.array()), text, put)


def join_pages(pages: Column) -> Column:
    """Pages as text with page marks; blank pages are left out but counted."""
    marked = F.transform(pages, lambda p, i: F.when(rx.strip(p) != "", F.concat(F.lit("<!-- Page "), (i + 1).cast("string"), F.lit(" -->\n"), p)))
    return F.array_join(F.filter(marked, lambda p: p.isNotNull()), "\n\n")


def tidy_description(text: Column) -> Column:
    """A generated picture description without stock phrases; ``TEXT_ONLY:`` answers stay as they are."""
    bare = rx.strip(text)
    # Phrases that say nothing.
    for phrase in ["この画像は図表ではありません。", "これは図表ではありません。", "図表ではありません。"]:
        text = F.replace(text, F.lit(phrase), F.lit(""))
    tidy = rx.strip(F.regexp_replace(text, r"\n{3,}", "\n\n"))
    return F.when(bare.startswith("TEXT_ONLY:"), bare).otherwise(tidy)

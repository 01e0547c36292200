"""Cleaning: golden values, plain versions on random texts, nulls and empty texts."""

import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import clean

ALPHABET = ["あ", "い", "漢", "ア", "ー", "a", "B", "1", "23", "456", " ", "  ", "\n", "\n\n", "　", "。", "．", "#", "# ", "...", "(", ")", "「", "」", "/", "-", "第1章", "目次", "CONTENTS", "Page 3", "```", "`", "・"]


def texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 18))) for _ in range(n)]


GOLDEN = [
    (clean.repair_lines, "あ\nい\nう", "あいう"),
    (clean.repair_lines, "hello\nworld.\nnext", "helloworld.next"),
    (clean.repair_lines, "輸\n  送 (A)\nB\n# H \ntail", "輸送 (A)\nB\n# H \ntail"),
    (clean.repair_lines, "終わり。\nABC\n\nx", "終わり。\nABC\n\nx"),
    (clean.nfkc, "…１？！．（）『』。㈱①ｶﾞ", "...1?!.()『』。(株)1ガ"),
    (clean.normalize_numbers, "2023 2024 / 5\n\n1 000", "20232024/5\n\n1000"),
    (clean.normalize_whitespace, "a \n \n \nb  c\n\n\n\nd ", "a\n\n\nb c\n\nd"),
    (clean.normalize_headings, "1.2 細目", "## 1. 2 細目"),
]


@pytest.mark.parametrize("f,given,wanted", GOLDEN)
def test_golden(column, f, given, wanted):
    assert column(f(F.col("text")), [given, None, ""]) == [wanted, None, ""]


def test_composed(column):
    t = clean.clean_japanese(clean.clean_markdown(clean.blank_before_headings(clean.normalize_headings(F.col("text")))))
    given = "第1章 概要\n本文です。\n\n次の段落\n続き\n\n1.2 細目\n内容\n\n# Intro\nbody line\n\nmore"
    assert column(t, [given]) == ["##第1章概要本文です。\n\n次の段落続き\n\n## 1. 2細目内容\n\n# Intro body line\n\nmore"]


def test_toc(column):
    s = clean.split_toc(F.col("text"))
    given = "前書き\n目 次\n第1章 概要\nはじめに...... 1\n\n結論 12\n\n\n本文"
    kept, other, none, empty = column(s, [given, "CONTENTS\nIntro 3\nThis is body text", None, ""])
    assert kept["text"] == "前書き\n\n本文" and kept["removed"] == ["目 次", "第1章 概要", "はじめに...... 1", "", "結論 12", ""]
    assert other["text"] == "This is body text" and other["removed"] == ["CONTENTS", "Intro 3"]
    assert none["text"] is None and empty["text"] == "" and empty["removed"] == []


def test_complete_sentence(column):
    cases = {"あ" * 19: False, "あ" * 20: True, "あ" * 101: False, "あ" * 100 + "。": True, "あ" * 20 + "の": False, "あ" * 20 + "(((": False, "あ" * 20 + "((": True, "": False}
    assert column(clean.is_complete_sentence(F.col("text")), [*cases, None]) == [*cases.values(), False]


def test_pages(column):
    s = clean.page_span(F.col("text"))
    a, b, c = column(s, ["<!-- Page 3 --> x <!-- Page 12 -->", "x", None])
    assert tuple(a) == (3, 12) and tuple(b) == (None, None) and tuple(c) == (None, None)


JP = "[ぁ-んァ-ヴー一-龠々〆〤]"


def plain_repair(text):
    text = re.sub(f"({JP})\\n+({JP})", r"\1\2", text)
    text = re.sub(f"({JP})\\n+\\s*({JP})", r"\1\2", text)
    out, held = [], None
    for line in text.split("\n"):
        bare = line.strip()
        if not bare or bare[0] == "#":
            out += ([held] if held is not None else []) + [line]
            held = None
        elif held is None:
            held = bare
        elif held[-1] in clean.LINE_ENDS:
            out.append(held)
            held = bare
        else:
            held += bare
    return "\n".join(out + ([held] if held is not None else []))


def plain_japanese(text):
    for p, r in [("  \n", " "), (" *\n *", "\n"), (f"[ ]+({JP})", r"\1"), (f"({JP})[ ]+", r"\1"), (f"({JP})\\n+({JP})", r"\1\2")]:
        text = re.sub(p, r, text)
    return text


def plain_markdown(text):
    text = re.sub(r"```(.*?)```", r"\1", text, flags=re.S)
    text = re.sub(r"`([^`]+)`", r"\1", text)
    text = re.sub(r"\n{2,}", "\0", text).replace("\n", " ").replace("\0", "\n\n")
    return re.sub(r"(#+) (.*?) (#+)", r"\1 \2\n\3", text).strip()


def plain_whitespace(text):
    return re.sub(r" {2,}", " ", re.sub(r" +\n", "\n", re.sub(r"\n{3,}", "\n\n", text))).strip()


def plain_drop(text, patterns):
    return "\n".join(x for x in text.split("\n") if not any(re.match(p, x, re.I) for p in patterns))


@pytest.mark.parametrize(
    "f,plain",
    [
        (clean.repair_lines, plain_repair),
        (clean.clean_japanese, plain_japanese),
        (clean.clean_markdown, plain_markdown),
        (clean.normalize_whitespace, plain_whitespace),
        (clean.drop_page_numbers, lambda x: plain_drop(x, clean.PAGE_NUMBER_LINES)),
        (clean.drop_headers_footers, lambda x: plain_drop(x, clean.HEADER_FOOTER_LINES)),
        (clean.nfkc, lambda x: unicodedata.normalize("NFKC", x)),
        (clean.normalize_numbers, lambda x: re.sub(r"(\d)\s*/\s*(\d)", r"\1/\2", re.sub(r"(\d)\s+(\d{3})", r"\1\2", x))),
    ],
)
def test_against_plain(column, f, plain):
    given = texts(400, 7)
    assert column(f(F.col("text")), given) == [plain(x) for x in given]


def test_cleaner_stats(spark):
    df = spark.createDataFrame([(1, "１２\n本文　です。\n- 3 -", 0), (2, None, 0)], "i int, text string, cleaned int")
    on, none = (r["cleaned"] for r in clean.clean_rows(df).orderBy("i").collect())
    assert on["removed_lines"] == ["12", "- 3 -"] and on["text"] == "本文 です。" and on["stats"]["original_chars"] == 15
    assert none["text"] is None and none["stats"] is None and clean.clean_rows(df).columns == ["i", "text", "cleaned"]
    off = clean.clean_rows(df, level="off").orderBy("i").first()["cleaned"]
    assert off["text"].startswith("１２") and off["removed_lines"] == [] and off["stats"] is None


def test_long_text(column):
    long = "あ \n" * 50_000 + " " * 50_000
    assert column(F.length(clean.normalize_whitespace(F.col("text"))), [long]) == [99_999]


def test_figures_and_tables(column):
    said = F.array(F.struct(F.lit("c").alias("caption"), F.lit("d").alias("description")))
    assert column(clean.substitute_figures(F.col("text"), said), ["a<figure x>1</figure>b<figure>2</figure>", None]) == ["a\n\n【図】c\nd\n\nb<figure>2</figure>", None]
    tables = F.array(F.struct(F.lit(1).alias("page"), F.lit(1).alias("number"), F.lit("T$1").alias("markdown")))
    got = column(clean.inject_tables(F.col("text"), tables), ["x [Table 1-1]", "<!-- Page 1 -->y", "z"])
    assert got == ["x T$1", "<!-- Page 1 -->\n\n### 表 1-1\nT$1\ny", "z"]
    assert column(clean.join_pages(F.split("text", r"\|", -1)), ["a| |b"]) == ["<!-- Page 1 -->\na\n\n<!-- Page 3 -->\nb"]
    assert column(clean.tidy_description(F.col("text")), ["図表ではありません。x\n\n\n\ny", "TEXT_ONLY: 図表ではありません。"]) == ["x\n\ny", "TEXT_ONLY: 図表ではありません。"]

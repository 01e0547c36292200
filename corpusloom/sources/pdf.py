"""PDF folders. Parsing is a pluggable provider; the default needs no library.

A provider is ``bytes -> list[str]``, the texts of the pages. ``embedded_text``
reads the literal strings of uncompressed content streams, enough for tests and
plain files; pass a real parser's function in production.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import clean

Parser = Callable[[bytes], list[str]]


def embedded_text(content: bytes) -> list[str]:
    """Pages of a simple PDF: the literal strings of each content stream, a line per ``Tj``."""
    pages = []
    for stream in re.findall(rb"stream\r?\n(.*?)endstream", content, re.DOTALL):
        shown = re.findall(rb"\(((?:[^()\\]|\\.)*)\)\s*Tj", stream)
        if shown:
            pages.append("\n".join(re.sub(rb"\\(.)", rb"\1", s).decode("utf-8", "replace") for s in shown))
    return pages


def read_pdfs(spark: SparkSession, folder: str, parser: Parser = embedded_text) -> DataFrame:
    """``(source_file, text, error)`` of each ``*.pdf`` directly in ``folder``.

    A file that cannot be parsed or has no text comes out with ``error`` set and
    null text; it never fails the job. An empty folder is an error.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(folder)
    if not files.take(1):
        raise FileNotFoundError(f"no *.pdf in {folder}")

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for path, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    pages, error = parser(bytes(content)), None
                    if not any(p.strip() for p in pages):
                        pages, error = None, "no text"
                except Exception as e:  # noqa: BLE001 - whatever a parser raises belongs to this file alone
                    pages, error = None, f"{type(e).__name__}: {e}"
                out.append((path.rsplit("/", 1)[-1], pages, error))
            yield pd.DataFrame(out, columns=["source_file", "pages", "error"])

    pages = files.select("path", "content").mapInPandas(parse, "source_file string, pages array<string>, error string")
    return pages.select("source_file", F.when(F.col("pages").isNotNull(), clean.join_pages(F.col("pages"))).alias("text"), "error")


def read_input(spark: SparkSession, path: str, parser: Parser = embedded_text) -> DataFrame:
    """A ``.jsonl``/``.json`` file, a ``.pdf`` file or a folder of them, by the suffix of ``path``; any other suffix is an error."""
    from corpusloom.sources import jsonl

    suffix = re.search(r"\.([^./\\]*)$", path.rstrip("/"))
    if not suffix or suffix[1].lower() == "pdf":
        return read_pdfs(spark, path, parser)
    if suffix[1].lower() in ("jsonl", "json"):
        return jsonl.lenient(spark, path)
    raise ValueError(f"unsupported input: .{suffix[1]}")


#: Bytes to ``(texts, tables)``; a table is ``(rows, columns, cells)`` and a cell ``(row, column, content, row span, column span)``.
LayoutParser = Callable[[bytes], tuple[list[str], list[tuple[int, int, list[tuple[int, int, str | None, int | None, int | None]]]]]]
_LAYOUT = "source_file string, texts array<string>, tables array<struct<row_count:int,column_count:int,cells:array<struct<row_index:int,column_index:int,content:string,row_span:int,column_span:int>>>>, error string"


def read_layout(spark: SparkSession, folder: str, parser: LayoutParser) -> DataFrame:
    """``(source_file, text, error)`` of each ``*.pdf``: its texts, then its tables as Markdown, from a parser of the layout.

    A file whose parser fails comes out with ``error`` set and null text.
    """
    from corpusloom.operators import layout

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(folder)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for path, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    texts, tables = parser(bytes(content))
                    error = None
                except Exception as e:  # noqa: BLE001 - whatever a parser raises belongs to this file alone
                    texts, tables, error = None, None, f"{type(e).__name__}: {e}"
                cells = ("row_index", "column_index", "content", "row_span", "column_span")
                shown = None if tables is None else [{"row_count": r, "column_count": c, "cells": [dict(zip(cells, x, strict=True)) for x in xs]} for r, c, xs in tables]
                out.append((path.rsplit("/", 1)[-1], texts, shown, error))
            yield pd.DataFrame(out, columns=["source_file", "texts", "tables", "error"])

    parts = files.select("path", "content").mapInPandas(parse, _LAYOUT)
    grids = F.transform("tables", lambda t: layout.grid(t["row_count"], t["column_count"], t["cells"]))
    return parts.select("source_file", F.when(F.col("error").isNull(), layout.combine_elements(F.col("texts"), grids)).alias("text"), "error")

"""Splitting a Markdown document into chunks by headings, then by size.

The heading splitter works on stripped, non-blank lines: a line is a heading of
a level if it equals the mark or starts with the mark and a space; lines of a
section are joined by two spaces and a line end; neighbouring sections with the
same heading are one; fenced code is opaque. The size splitter tries a blank
line, a line end, a space, then single characters, keeps the separator at the
start of the piece after it, merges pieces greedily and repeats a tail of at
most ``overlap`` characters.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Heading marks by level.
LEVELS = [("#", "H1"), ("##", "H2"), ("###", "H3"), ("####", "H4")]


def split_headings(text: str, mark: str) -> list[tuple[str, str | None]]:
    """``(section, heading)`` for one heading level; text before the first heading has heading None."""
    groups: list[tuple[str | None, list[str]]] = []
    heading: str | None = None
    fence = ""
    for raw in text.split("\n"):
        line = raw.strip()
        if fence:
            if line.startswith(fence):
                fence = ""
        elif line[:3] in ("```", "~~~") and line.count("```") <= 1:
            fence = line[:3]
        elif line == mark or line.startswith(mark + " "):
            heading = line[len(mark) :].strip()
            groups.append((heading, []))
        if not line:
            continue
        if not groups or groups[-1][0] != heading:
            groups.append((heading, []))
        groups[-1][1].append(line)
    merged: list[tuple[str | None, list[str]]] = []
    for h, ls in groups:
        if merged and merged[-1][0] == h:
            merged[-1][1].extend(ls)
        elif ls:
            merged.append((h, ls))
    return [("  \n".join(ls), h) for h, ls in merged]


def split_size(text: str, size: int, overlap: int, separators: tuple[str, ...] = ("\n\n", "\n", " ", "")) -> list[str]:
    """Pieces of at most ``size`` characters, stripped; blank ones are left out."""
    at = next(i for i, s in enumerate(separators) if s == "" or s in text)
    sep, finer = separators[at], separators[at + 1 :]
    if sep:
        cut = re.split(f"({re.escape(sep)})", text)
        parts = [p for p in [cut[0]] + [cut[i] + cut[i + 1] for i in range(1, len(cut), 2)] if p]
    else:
        parts = list(text)
    out: list[str] = []
    held: list[str] = []

    def merge() -> None:
        window: list[str] = []
        total = 0
        for p in held:
            if total + len(p) > size and window:
                out.append("".join(window).strip())
                while window and (total > overlap or (total + len(p) > size and total > 0)):
                    total -= len(window.pop(0))
            window.append(p)
            total += len(p)
        if window:
            out.append("".join(window).strip())
        held.clear()

    for p in parts:
        if len(p) < size:
            held.append(p)
        else:
            merge()
            out.extend(split_size(p, size, overlap, finer) if finer else [p])
    merge()
    return [p for p in out if p]


def chunks_of(text: str, size: int = 1500, overlap: int = 100) -> list[tuple[str, list[str]]]:
    """``(text, headings)`` of every chunk in order, blank ones included."""
    parts: list[tuple[str, dict[str, str]]] = [(text, {})]
    for mark, name in LEVELS:
        nxt: list[tuple[str, dict[str, str]]] = []
        for chunk, meta in parts:
            found = split_headings(chunk, mark) if len(chunk) > size else []
            nxt.extend([(c, meta | ({name: h} if h is not None else {})) for c, h in found] if len(found) > 1 else [(chunk, meta)])
        parts = nxt
    final: list[tuple[str, dict[str, str]]] = []
    for chunk, meta in parts:
        final.extend([(chunk, meta)] if len(chunk) <= size else [(p, meta) for p in split_size(chunk, size, overlap)])
    return [(c, [m[n] for _, n in LEVELS if n in m]) for c, m in final]


_OUT = "source_file string, id string, text string, meta struct<source_file:string,chunk_id:int,section_path:string,page_start:int,page_end:int,hierarchical_level:int>, error string"


def chunk_documents(df: DataFrame, source_file: str = "source_file", text: str = "text", size: int = 1500, overlap: int = 100) -> DataFrame:
    """Chunks of each document with their section path and pages.

    Numbers count blank chunks, which are then left out, so ids may have gaps.
    A document that is null, blank or gives no chunk comes out as one row with
    ``error`` set; it never fails the job.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for name, doc in zip(b["f"], b["x"], strict=True):
                if doc is None or not doc.strip():
                    rows.append((name, None, None, None, "empty"))
                    continue
                stem = re.sub(r"(?<=.)\.[^./]*$", "", (name or "").rsplit("/", 1)[-1])
                for i, (chunk, heads) in enumerate(chunks_of(doc, size, overlap)):
                    chunk = chunk.strip()
                    if chunk:
                        pages = [int(n) for n in re.findall(r"<!-- Page (\d{1,9}) -->", chunk)]
                        meta = {"source_file": name, "chunk_id": i + 1, "section_path": " › ".join(heads), "page_start": pages[0] if pages else None, "page_end": pages[-1] if pages else None, "hierarchical_level": len(heads)}
                        rows.append((name, f"{stem}_c{i + 1}", chunk, meta, None))
            yield pd.DataFrame(rows, columns=["source_file", "id", "text", "meta", "error"])

    return df.select(F.col(source_file).alias("f"), F.col(text).alias("x")).mapInPandas(run, _OUT)

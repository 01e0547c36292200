"""Cutting oversized texts at natural boundaries, with overlap.

Sizes are differences of a prefix sum over the text's units, so any measure
that adds up works: characters by default, or the tokens of a tokenizer. For
each kind of boundary (paragraph, line, sentence; each holds those before it)
the cut positions are one sorted array. A piece ends at the last boundary of
the coarsest kind that a binary search finds under the limit; where no kind has
one, at a hard cut that spares page marks and Latin words. The next piece
starts at a boundary up to ``overlap`` units back, or exactly that far back.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("paragraph", "line", "sentence")
_BREAK = r"(?:\r\n|[\n\r\v\f\x85\u2028\u2029])"
_PARAGRAPH = re.compile(rf"{_BREAK}(?:[ 　]*{_BREAK})+")
_LINE = re.compile(_BREAK)
_SENTENCE = re.compile(rf"[。．？！?!]|\.(?=\s|\Z)|{_BREAK}")
_BLANK = np.array([ord(c) for c in " 　\n\r\v\f\x85\u2028\u2029"], dtype=np.uint32)
_MARK = re.compile(r"<!-- Page (\d{1,9}) -->")
_WORD = re.compile(r"[A-Za-z]{2,30}")

Measure = Callable[[str], np.ndarray]


def by_characters(text: str) -> np.ndarray:
    """Prefix sums of one unit a code point."""
    return np.arange(len(text) + 1, dtype=np.int64)


def by_tokens(path: str) -> Measure:
    """Prefix sums of tokens: a code point counts the tokens that begin in its bytes."""

    def measure(text: str) -> np.ndarray:
        from corpusloom.llm.tokens import encoder

        tool = encoder(path)
        sizes = [len(b) for b in tool.decode_tokens_bytes(tool.encode_ordinary(text))]
        begins = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64) if sizes else np.zeros(0, np.int64)
        raw = np.frombuffer(text.encode(), dtype=np.uint8)
        char_of_byte = np.cumsum((raw & 0xC0) != 0x80) - 1
        return np.concatenate([[0], np.cumsum(np.bincount(char_of_byte[begins], minlength=len(text)))]).astype(np.int64)

    return measure


class Boundaries:
    """Where a text may be cut, and its content positions."""

    def __init__(self, text: str):
        self.text, self.n = text, len(text)
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        self.solid = np.flatnonzero(~np.isin(codes, _BLANK))  # positions that are no blank
        cuts = [[m.end() for m in p.finditer(text)] for p in (_PARAGRAPH, _LINE, _SENTENCE)]
        # a blank line may open the text, where no line break comes before it
        self.cuts = [np.array(sorted({*cuts[0]}), dtype=np.int64), np.array(sorted({*cuts[0], *cuts[1]}), dtype=np.int64), np.array(sorted({*cuts[0], *cuts[1], *cuts[2]}), dtype=np.int64)]

    def content_start(self, at: np.ndarray | int) -> np.ndarray:
        """The first solid position at or after each position; the text's length where there is none."""
        k = np.searchsorted(self.solid, at)
        return np.where(k < len(self.solid), self.solid[np.minimum(k, len(self.solid) - 1)], self.n) if len(self.solid) else np.full(np.shape(at), self.n)

    def content_end(self, at: np.ndarray | int) -> np.ndarray:
        """One past the last solid position before each position; 0 where there is none."""
        k = np.searchsorted(self.solid, at) - 1
        return np.where(k >= 0, self.solid[np.maximum(k, 0)] + 1, 0) if len(self.solid) else np.zeros(np.shape(at), np.int64)

    def falls_into(self, most: int) -> str:
        """The first kind whose stretches, without blanks at their ends, have at most ``most`` characters; else ``none``."""
        for kind, cuts in zip(KINDS, self.cuts, strict=True):
            edges = np.concatenate([[0], cuts, [self.n]])
            if (self.content_end(edges[1:]) - self.content_start(edges[:-1])).max(initial=0) <= most:
                return kind
        return "none"


def pieces_of(text: str, limit: int = 1500, overlap: int = 100, measure: Measure = by_characters) -> list[tuple[int, int, int, str]]:
    """``(start, new, end, kind)`` of each piece: ``text[start:end]``, of which ``text[start:new]`` repeats the piece before.

    What lies between one piece's end and the next one's ``new`` is blank, so
    the pieces hold the whole text. ``kind`` says what the piece ends at. A text
    of blanks alone is one empty piece.
    """
    if not 0 <= overlap < limit:
        raise ValueError("the overlap must be less than the limit")
    b = Boundaries(text)
    size = measure(text)
    if not len(b.solid):
        return [(0, 0, 0, "end")]
    last = int(b.solid[-1]) + 1
    start = new = int(b.solid[0])
    marks = [(m.start(), m.end()) for m in _MARK.finditer(text)]
    ends = [b.content_end(c) for c in b.cuts]
    ends = [e[~np.isin(e, [hi for _, hi in marks])] for e in ends]  # a page mark stays with what follows it
    out: list[tuple[int, int, int, str]] = []
    while True:
        most = int(np.searchsorted(size, size[start] + limit, side="right")) - 1  # the furthest end under the limit
        if most >= last:
            out.append((start, new, last, "end"))
            return out
        end, kind = 0, "none"
        for cut_ends, name in zip(ends, KINDS, strict=True):
            k = int(np.searchsorted(cut_ends, most, side="right")) - 1
            if k >= 0 and cut_ends[k] > new:
                end, kind = int(cut_ends[k]), name
                break
        if kind == "none":
            end = max(most, new + 1)
            for lo, hi in marks:
                if lo < end < hi and lo > new:
                    end = lo
            for m in _WORD.finditer(text, max(new, end - 31), min(b.n, end + 31)):
                if m.start() < end < m.end() and m.start() > new:
                    end = m.start()
            end = max(int(b.content_end(end)), new + 1)
        out.append((start, new, end, kind))
        new = int(b.content_start(end))
        back = int(np.searchsorted(size, size[new] - overlap, side="left"))
        back = max(back, out[-1][1] + 1)
        k = int(np.searchsorted(b.cuts[2], back, side="left"))
        at = int(b.content_start(b.cuts[2][k])) if k < len(b.cuts[2]) else new
        start = at if at < new else int(b.content_start(min(back, new)))
        for lo, hi in marks:
            if lo < start < hi:
                start = min(hi, new)
        start = int(b.content_start(start))


def pages_of(text: str, pieces: list[tuple[int, int, int, str]]) -> list[tuple[int | None, int | None]]:
    """First and last page of each piece: the mark in force at its start, else its first mark; and the last mark before its end."""
    marks = [(m.start(), int(m[1])) for m in _MARK.finditer(text)]
    out = []
    for start, _, end, _ in pieces:
        before = [p for at, p in marks if at <= start]
        inside = [p for at, p in marks if start < at < end]
        first = before[-1] if before else (inside[0] if inside else None)
        out.append((first, inside[-1] if inside else first))
    return out


_META = "struct<source_file:string,chunk_id:int,section_path:string,page_start:int,page_end:int,hierarchical_level:int>"


def split_oversized(df: DataFrame, limit: int = 1500, overlap: int = 100, stretch: int = 1400, measure: Measure = by_characters, key: str = "id", text: str = "text", meta: str = "meta") -> DataFrame:
    """``(id, piece, pieces, text, overlap, start, end, cut, boundary, meta)`` of every row longer than ``limit``.

    Pieces are numbered from 1; ``overlap`` is how many of a piece's characters
    repeat the one before; ``cut`` is what the piece ends at; ``boundary`` is
    the kind of boundary at which the whole text falls into stretches of at
    most ``stretch`` characters. ``meta`` is carried on with the pages of the
    piece. Rows at or under the limit and null texts give nothing: they need no
    cut. With a token measure the length test uses characters as an upper bound
    only if every token has one or more, as byte-level tokenizers don't promise,
    so all rows are measured then. Rows delivered again give the same pieces
    again; drop duplicates by ``(id, piece)``.
    """
    rows = df.where(F.length(text) > limit) if measure is by_characters else df.where(F.col(text).isNotNull())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for k, x, m in zip(batch["k"], batch["x"], batch["m"], strict=True):
                if measure is not by_characters and measure(x)[-1] <= limit:
                    continue
                boundary = Boundaries(x).falls_into(stretch)
                pieces = pieces_of(x, limit, overlap, measure)
                for i, ((s, new, e, kind), (first, final)) in enumerate(zip(pieces, pages_of(x, pieces), strict=True), 1):
                    about = None if m is None else dict(m) | {"page_start": first, "page_end": final}
                    out.append((k, i, len(pieces), x[s:e], new - s, s, e, kind, boundary, about))
            yield pd.DataFrame(out, columns=["id", "piece", "pieces", "text", "overlap", "start", "end", "cut", "boundary", "meta"])

    return rows.select(F.col(key).alias("k"), F.col(text).alias("x"), F.col(meta).cast(_META).alias("m")).mapInPandas(
        run, f"id string, piece int, pieces int, text string, overlap int, start int, end int, cut string, boundary string, meta {_META}"
    )

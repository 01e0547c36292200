"""Repairing text that was read from scanned pages.

The corpus teaches what its words are. Its distinct texts count, each once,
however many rows are copies. A first pass counts words: katakana and
Latin words, and pairs of neighbouring characters around kanji that are easily
taken for another. Words with a plausible glyph edit into one that is many
times more frequent are linked to it. A second pass counts the contexts of
linked words, from which skip-gram vectors are trained; a link stays if the
contexts of the rare form fit the vector of the frequent one. What is left is
a lexicon of misreadings, which the workers get to find and correct misread
words in their text. Linking is a join and vectors are trained in groups of
links, so neither the words nor the links have to fit in one place; the lexicon
holds the misread forms, 8 bytes per katakana word, and kanji pairs.

Words split over line ends are joined first, so that halves aren't words.
Furniture are page numbers in any dress and running heads, which are the
file's title or short title with or without number, year or chapter: short
lines meet the titles in a join of small rows, never the texts.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.session import checkpointed

# Signs taken for a katakana letter, and letters taken for each other, misread first.
KATAKANA = {"ソ": "ン", "ツ": "シ", "一": "ー", "二": "ニ", "力": "カ", "夕": "タ", "卜": "ト", "工": "エ", "八": "ハ", "口": "ロ", "才": "オ", "千": "チ", "三": "ミ", "ン": "ソ", "シ": "ツ"}
# Kanji taken for another, misread first.
KANJI = {
    "熟": "熱", "袖": "軸", "維": "継", "冶": "冷", "庄": "圧", "麿": "摩", "庶": "度", "因": "固", "蜜": "密", "上": "止", "軽": "転", "勤": "動", "琉": "流", "昔": "音", "倹": "験", "頁": "負",
    "末": "未", "未": "末", "士": "土", "干": "千", "曰": "日", "太": "大", "犬": "大", "入": "人", "刀": "力", "徴": "微", "積": "績", "績": "積", "識": "織", "織": "識", "問": "間", "間": "問",
    "検": "険", "険": "検", "遣": "遺", "侍": "待", "衡": "衝", "縁": "緑", "緑": "縁", "輪": "輸", "輸": "輪", "堀": "掘", "侯": "候", "抽": "油", "村": "材", "側": "測", "測": "側", "植": "値", "教": "数",
}
# Latin letters and digits taken for others, misread first.
LATIN = [("1", "i"), ("1", "l"), ("0", "o"), ("5", "s"), ("6", "b"), ("9", "g"), ("8", "b"), ("c", "e"), ("e", "c"), ("rn", "m"), ("m", "rn"), ("d", "cl"), ("cl", "d"), ("vv", "w"), ("ii", "u"), ("li", "h"), ("h", "b")]
# Letters taken for digits.
DIGITS = {"O": "0", "o": "0", "l": "1", "I": "1", "S": "5", "B": "8", "Z": "2"}
HYPHENS = "-‐‑­¬"

#: How many times more frequent the right word must be, and how often it must occur.
RATIO, LEAST = 15, 8
#: Bits of the filter that keeps most edits that are no words out of the join: more words only let more edits through.
FILTER = 1 << 27
#: Links whose vectors are trained together, on average.
TOGETHER = 2_500
#: Longest word and form.
LONGEST = 40
#: Context buckets, context width, vector length.
BUCKETS, WIDTH, LENGTH = 512, 3, 24

_KATA_MIS = "".join(k for k in KATAKANA if not "ァ" <= k <= "ヴ")
_TOKEN = re.compile(rf"[{_KATA_MIS}]{{0,2}}[ァ-ヴー][ァ-ヴー{_KATA_MIS}]*|[A-Za-z0-9]*[A-Za-z][A-Za-z0-9]*|(?:(?![{_KATA_MIS}]{{1,2}}[ァ-ヴー])[一-龠々])+")
_KANJI_PAIR = re.compile("[" + "".join(sorted({*KANJI, *KANJI.values()})) + "]")
_JP_BREAK = re.compile(r"(?<=[ぁ-んァ-ヴー一-龠々、])[ 　\t]*\r?\n[ 　\t]*(?=[ぁ-んァ-ヴー一-龠々、。])")
_SPLIT_WORD = re.compile(rf"([A-Za-z0-9]+)[{HYPHENS}][ 　\t]*\r?\n[ 　\t]*([A-Za-z0-9]*[a-z][A-Za-z0-9]*)")
_LETTER = "A-Za-z0-9Ａ-Ｚａ-ｚ０-９À-ɏΑ-ωА-яЀ-Џѐ-ӿ"
#: The same with one short line between the halves, as a running head is.
_SPLIT_OVER = re.compile(rf"([A-Za-z0-9]+)[{HYPHENS}][ 　\t]*\r?\n([^\n。]{{3,80}})\n[ 　\t]*([a-z][A-Za-z0-9]*)")
_NUMBER = re.compile(rf"(?<![{_LETTER}_\\{{}}^$#&;/\-​-‏⁠﻿­])(?=[0-9OlIS.]*[0-9])(?=[0-9.]*[OlIS])[0-9OlIS]+(?:\.[0-9OlIS]+)?(?![{_LETTER}_}}^/​-‏⁠﻿­])")
_DRESS = re.compile(r"[\s　\-–—−‐‑・･•~〜=*.\[\]()（）〔〕【】<>《》「」]*")
_PAGE = re.compile(
    r"[\s　\-–—−‐‑・･•~〜=*\[(（〔【<《「]*(?:(?:p(?:age|p)?|No)[.．]?|頁|ページ|第)?[\s　]*(\d{1,4})[\s　]*(?:(?:[/／]|of|中)[\s　]*\d{1,4})?[\s　]*(?:頁|ページ|page)?[\s　\-–—−‐‑・･•~〜=*\])）〕】>》」]*", re.IGNORECASE
)
_BARE_NUMBER = re.compile(r"[\s　]*[-+−]?\d[\d.,]*[\s　]*")
_DIGIT = re.compile(r"\d")
_VALUES = re.compile(r"測定値|[(（][^()（）]{1,12}[)）]\s*$")
_MARK = re.compile(r"<!-- Page \d+ -->")
#: What stands beside the title in a running head: a number, volume, year or chapter. Each item is known by its first sign, so that none is read twice.
_HEAD_FIRST = re.compile(r"\d{1,4}|[Pp](?:age)?\.?\d{1,4}")
_HEAD_LAST = re.compile(r"(?:\d++|[Vv]ol\.?\d++|No\.?\d++|[(（]\d{4}年?(?:\d{1,2}月)?[)）]|第\d+[章節編部巻号回]|[-–—−・|｜/])++$")
_DIGITS = "".join(c for c in map(chr, range(0x110000)) if c.isdecimal())
#: The signs with which the latter ends, and all it may be made of.
_HEAD_ENDS = ")）章節編部巻号回-–—−・|｜/" + _DIGITS
_HEAD_SIGNS = _HEAD_ENDS + "(（年月第VvolN."


def _flow(text: str) -> str:
    """The text with wrapped Japanese lines and hyphenated words joined, page numbers and marks left out."""
    if "\n" in text:
        kept = [line for line, page in zip(text.split("\n"), page_lines(text.split("\n")), strict=True) if not page]
        text = _SPLIT_WORD.sub(r"\1\2 ", "\n".join(kept))
        text = _SPLIT_OVER.sub(r"\1\3 \n\2\n", text)
        text = _JP_BREAK.sub("", text)
    return text


def page_lines(lines: list[str]) -> list[bool]:
    """Which lines hold a page number and nothing else.

    A number without any dress counts only by itself: not in a column of
    numbers and not under the heading of one. Page marks of the format and
    blank lines don't count.
    """
    out = [False] * len(lines)
    short = [i for i, x in enumerate(lines) if len(x) <= 60 and _DIGIT.search(x) and len(x.strip()) <= 20]
    for i in short:
        x = lines[i]
        bare = x.strip()
        if not _PAGE.fullmatch(x):
            continue
        if _BARE_NUMBER.fullmatch(x):
            before = next((lines[k] for k in range(i - 1, -1, -1) if lines[k].strip()), "")
            after = next((lines[k] for k in range(i + 1, len(lines)) if lines[k].strip()), "")
            if not bare.isdigit() or _BARE_NUMBER.fullmatch(before) or _BARE_NUMBER.fullmatch(after) or _VALUES.search(before):
                continue
        elif bare[0] == "・" and not bare.endswith("・"):
            continue  # a list entry
        out[i] = True
    return out


class Batch:
    """The words of many texts at once, as arrays over their code points.

    Wrapped Japanese lines and hyphenated words are joined by masks. A word is
    a run of Latin letters and digits, of katakana (with signs easily taken for
    katakana next to it) or of kanji; it is known by a 64-bit hash of its code
    points, Latin ones in lower case.
    """

    def __init__(self, texts: list[str]):
        t = _tables()
        codes = np.frombuffer("\0".join(["", *texts, ""]).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        codes = codes[self._flow(codes, t)]
        kind = t.kind[codes]
        kata, sign = kind == 3, t.sign[codes]
        for _ in range(2):  # signs count as katakana beside it
            beside = np.zeros(len(kata), dtype=bool)
            beside[1:] |= kata[:-1]
            beside[:-1] |= kata[1:]
            kata = kata | (sign & beside)
        run = np.where(kata, 3, np.where(kind == 2, 1, kind)).astype(np.int8)
        edge = np.flatnonzero(np.diff(run, prepend=0, append=0))
        start, end = edge[:-1], edge[1:]
        word = np.isin(run[start], (1, 3, 4))
        self.start, self.end = start[word], end[word]
        self.run = run[self.start]
        lower = np.where((codes >= 65) & (codes <= 90), codes + 32, codes).astype(np.uint64)
        self.hash = _hashes(lower, self.start, self.end)
        letters = np.concatenate([[0], np.cumsum(kind == 1)])
        self.latin = (self.run == 1) & (letters[self.end] > letters[self.start])
        self.codes, self.lower = codes, lower.astype("<u4")
        doc = np.cumsum(codes == 0) - 1
        self.doc = doc[self.start]
        self.at = np.flatnonzero(t.pair[codes])  # kanji that are easily misread or stand for such
        self.at_doc = doc[self.at]
        wide = codes.astype(np.int64)
        self.left = (wide[self.at - 1] << 21 | wide[self.at]) << 1
        self.right = (wide[self.at] << 21 | wide[self.at + 1]) << 1 | 1
        digit, odd = kind == 2, t.odd[codes]
        touch = np.zeros(len(codes), dtype=bool)  # a letter for a digit beside a digit or a point
        near = digit | (codes == 46)
        touch[1:] |= odd[1:] & near[:-1]
        touch[:-1] |= odd[:-1] & near[1:]
        self.numbered = np.unique(doc[touch])

    @staticmethod
    def _flow(codes: np.ndarray, t: "_Tables") -> np.ndarray:
        """Which code points are left when lines are joined."""
        keep = np.ones(len(codes), dtype=bool)
        ends = np.flatnonzero(codes == 10)
        if not len(ends):
            return keep
        solid, at = ~t.blank[codes], np.arange(len(codes))
        left = np.maximum.accumulate(np.where(solid, at, 0))[ends - 1]  # over blanks at the line's end and indentation
        right = np.minimum.accumulate(np.where(solid, at, len(codes) - 1)[::-1])[::-1][ends + 1]
        a, b = t.kind[codes[left]], t.kind[codes[right]]
        comma, stop = codes == 0x3001, codes == 0x3002
        japanese = ((a >= 3) | comma[left]) & ((b >= 3) | comma[right] | stop[right])
        before = t.kind[codes[left - 1]]
        latin = t.hyphen[codes[left]] & ((before == 1) | (before == 2)) & (b == 1) & (codes[right] >= 97)
        cut = np.zeros(len(codes) + 1, dtype=np.int32)
        np.add.at(cut, left[japanese] + 1, 1)
        np.add.at(cut, right[japanese], -1)
        np.add.at(cut, left[latin], 1)
        np.add.at(cut, right[latin], -1)
        return np.cumsum(cut[:-1]) == 0

    def text(self, k: int) -> str:
        """The word with number ``k``, Latin in lower case."""
        return self.lower[self.start[k] : self.end[k]].tobytes().decode("utf-32-le")


_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of the base and of its inverse."""
    return np.cumprod(np.full(n, _BASE, dtype=np.uint64)), np.cumprod(np.full(n, _INVERSE, dtype=np.uint64))


def _hashes(codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of runs of code points, the same wherever a run stands."""
    power, back = _powers(max(1 << 20, len(codes) + 1))  # one table for all but very long texts
    with np.errstate(over="ignore"):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(codes.astype(np.uint64, copy=False) * power[: len(codes)])])
        return (sums[end] - sums[start]) * back[start]


def word_hash(word: str) -> int:
    """The hash by which a batch knows a word."""
    out, power = 0, int(_BASE)
    for c in word:
        out = (out + ord(c) * power) & 0xFFFFFFFFFFFFFFFF
        power = power * int(_BASE) & 0xFFFFFFFFFFFFFFFF
    # the first code point of a run at position s weighs BASE^(s+1), and the run is scaled by BASE^-(s+1)
    return out * int(_INVERSE) & 0xFFFFFFFFFFFFFFFF


def pair_key(unit: str) -> int:
    """The key by which a batch knows a kanji with its left or right neighbour."""
    return (ord(unit[1]) << 21 | ord(unit[2])) << 1 | (unit[0] == ">") if len(unit) == 3 else -1


class _Tables:
    def __init__(self) -> None:
        top = 0x110000
        self.kind = np.zeros(top, dtype=np.uint8)  # 1 Latin letter, 2 digit, 3 katakana, 4 kanji, 5 hiragana
        self.kind[65:91] = self.kind[97:123] = 1
        self.kind[48:58] = 2
        self.kind[ord("ァ") : ord("ヴ") + 1] = 3
        self.kind[ord("ー")] = 3
        self.kind[ord("一") : ord("龠") + 1] = 4
        self.kind[ord("々")] = 4
        self.kind[ord("ぁ") : ord("ん") + 1] = 5

        def of(chars) -> np.ndarray:
            out = np.zeros(top, dtype=bool)
            out[[ord(c) for c in chars]] = True
            return out

        self.sign, self.blank, self.hyphen = of(_KATA_MIS), of(" \t　\r"), of(HYPHENS)
        self.pair, self.odd = of({*KANJI, *KANJI.values()}), of("OlIS")
        self.space = of(c for c in map(chr, range(0x3001)) if c.isspace())
        self.first, self.last = of(_DIGITS + "Pp"), of(_HEAD_ENDS)  # beside a title
        self.fold = np.arange(top, dtype="<u4")
        self.fold[[ord(k) for k in _FOLD]] = [ord(v) for v in _FOLD.values()]


@lru_cache(maxsize=1)
def _tables() -> _Tables:
    return _Tables()


def runs_of(texts: list[str | None], most: int = 600_000) -> Iterator[tuple[list[int], list[str]]]:
    """Row numbers and texts of runs of rows of up to about ``most`` characters; rows without text are left out."""
    rows: list[int] = []
    held: list[str] = []
    size = 0
    for i, x in enumerate(texts):
        if x:
            rows.append(i)
            held.append(x)
            size += len(x)
            if size >= most:
                yield rows, held
                rows, held, size = [], [], 0
    if rows:
        yield rows, held


def batches_of(texts: list[str | None], most: int = 600_000) -> Iterator[tuple[list[int], Batch]]:
    """The same with the words of each run."""
    for rows, held in runs_of(texts, most):
        yield rows, Batch(held)


def distinct_texts(df: DataFrame, text: str = "text") -> DataFrame:
    """One row per distinct text, null left out; copies are folded where they are, so a text any number of rows share sends one row per task."""
    return df.where(F.col(text).isNotNull()).groupBy(F.md5(text).alias("__md5")).agg(F.first(text).alias(text)).select(text)


def count_units(df: DataFrame, text: str = "text") -> DataFrame:
    """``(unit, n)`` over all rows: katakana words, Latin words, and kanji with a neighbour, marked by its side.

    Each task adds up its own first; words are spelled out once per task.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter[str] = Counter()
        spelled: dict[int, str] = {}
        for b in batches:
            for _, words in batches_of(list(b["x"])):
                size = words.end - words.start
                ok = (words.latin & (size >= 3) | (words.run == 3) & (size >= 2)) & (size <= LONGEST)
                which = np.flatnonzero(ok)
                key, first, n = np.unique(words.hash[which], return_index=True, return_counts=True)
                for h, k, c in zip(key.tolist(), which[first].tolist(), n.tolist(), strict=True):
                    if h not in spelled:
                        spelled[h] = words.text(k)
                    counts[spelled[h]] += c
                for keys in (words.left, words.right):
                    key, n = np.unique(keys, return_counts=True)
                    for h, c in zip(key.tolist(), n.tolist(), strict=True):
                        a, z = chr(h >> 22), chr(h >> 1 & 0x1FFFFF)
                        counts["<>"[h & 1] + a + z] += c
            if len(counts) > 500_000:
                yield pd.DataFrame(list(counts.items()), columns=["unit", "n"])
                counts.clear()
                spelled.clear()
        yield pd.DataFrame(list(counts.items()), columns=["unit", "n"])

    return df.select(F.col(text).alias("x")).mapInPandas(run, "unit string, n long").groupBy("unit").agg(F.sum("n").alias("n"))


def edits(unit: str, most: int = 3) -> set[str]:
    """Pairs of kanji, or Latin words, that ``unit`` may have been before up to ``most`` plausible misreadings of its glyphs."""
    if unit[0] in "<>":
        at = 2 if unit[0] == "<" else 1
        right = KANJI.get(unit[at]) if len(unit) > at else None
        return {unit[:at] + right + unit[at + 1 :]} if right else set()
    if unit[0] < "\x80":
        found, edge = set(), {unit}
        for _ in range(most):
            edge = {w[:i] + right + w[i + len(mis) :] for w in edge for mis, right in LATIN for i in range(len(w)) if w.startswith(mis, i)} - found - {unit}
            found |= edge
        return found
    return set()  # katakana words meet by their folded form


_ALIKE = str.maketrans({k: KATAKANA[k] for k in KATAKANA if k not in "ンシ"})


def keys(unit: str) -> set[str]:
    """What a unit meets frequent words by: a katakana word by its form with all that looks alike made one, others by the words they may have been."""
    if unit[0] in "<>" or unit[0] < "\x80":
        return edits(unit)
    return {"=" + unit.translate(_ALIKE)}


def known_by(word: str) -> str:
    """What a frequent word is met by."""
    return word if word[0] in "<>" or word[0] < "\x80" else "=" + word.translate(_ALIKE)


class Lexicon(NamedTuple):
    """Frequent katakana words, what misread forms stand for, and frequent kanji pairs that are none.

    Words are sorted hashes, those with a sign taken for katakana apart. Kanji
    pairs have a mark for the side of their neighbour; there are those around
    kanji of misread pairs.
    """

    words: np.ndarray
    signed: np.ndarray
    misread: dict[str, str]
    pairs: frozenset[str] = frozenset()


def _filter(words: DataFrame, bit: Column) -> bytes:
    """The bits that ``bit`` names, below ``FILTER``: as many places whatever the number of words."""
    slots = words.select(F.floor(bit / 64).cast("int").alias("slot"), (bit % 64).cast("int").alias("b"))
    bits = np.zeros(FILTER // 64, dtype="<i8")
    for r in slots.groupBy("slot").agg(F.bit_or(F.expr("shiftleft(1L, b)")).alias("w")).toLocalIterator():
        bits[r["slot"]] = r["w"]
    return bits.tobytes()


def links(units: DataFrame) -> DataFrame:
    """``(form, word, n, of)`` for forms that a glyph edit turns into a unit that is ``RATIO`` times as frequent: the most frequent such.

    Edits meet the words in a join. A filter of fixed size leaves out most of
    those that are no words before; what it lets through in vain costs a row.
    """
    by = F.pandas_udf(lambda s: s.map(known_by), "string")
    words = checkpointed(units.where(F.col("n") >= max(LEAST, RATIO)).select(F.col("unit").alias("word"), F.col("n").alias("of"), by("unit").alias("key")))  # a form occurs once at least
    known = _filter(words, F.crc32("key") % FILTER)

    def propose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = []
        for b in batches:
            for unit, n in zip(b["unit"], b["n"], strict=True):
                for w in keys(unit):
                    h = zlib.crc32(w.encode()) % FILTER
                    if known[h >> 3] >> (h & 7) & 1:
                        out.append((unit, w, n))
                if len(out) > 100_000:
                    yield pd.DataFrame(out, columns=["form", "key", "n"])
                    out = []
        yield pd.DataFrame(out, columns=["form", "key", "n"])

    proposed = units.mapInPandas(propose, "form string, key string, n long")
    met = proposed.join(words, "key").where((F.col("form") != F.col("word")) & (F.col("of") >= RATIO * F.col("n")))
    return met.groupBy("form", "n").agg(F.max(F.struct("of", "word")).alias("best")).select("form", "best.word", "n", "best.of")


def contexts(df: DataFrame, known: list[str], text: str = "text") -> DataFrame:
    """``(unit, bucket, n)``: counts of context buckets within ``WIDTH`` words of each unit in ``known``, by its number, over all rows."""

    def index(units: list[tuple[int, int]], kind: type) -> tuple[np.ndarray, np.ndarray]:
        have, number = np.array([k for k, _ in units], dtype=kind), np.array([i for _, i in units], dtype=np.int64)
        order = np.argsort(have)
        return have[order], number[order]

    plain = index([(word_hash(u), i) for i, u in enumerate(known) if u[0] not in "<>"], np.uint64)
    pairs = index([(pair_key(u), i) for i, u in enumerate(known) if u[0] in "<>"], np.int64)

    def find(index: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> np.ndarray:
        """The unit of each key, or -1."""
        have, unit = index
        if not len(have):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(have, keys), len(have) - 1)
        return np.where(have[at] == keys, unit[at], -1)

    def fold(cells: list[np.ndarray]) -> pd.DataFrame:
        cell, n = np.unique(np.concatenate([np.empty(0, dtype=np.int64), *cells]), return_counts=True)
        return pd.DataFrame({"cell": cell, "n": n})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[np.ndarray] = []
        size = 0
        for b in batches:
            for _, words in batches_of(list(b["x"])):
                bucket = (words.hash >> np.uint64(40)).astype(np.int64) % BUCKETS
                where, who = [], []
                unit = find(plain, words.hash)
                hit = np.flatnonzero(unit >= 0)
                where.append(hit)
                who.append(unit[hit])
                inside = np.searchsorted(words.start, words.at, side="right") - 1
                for keys in (words.left, words.right):
                    unit = find(pairs, keys)
                    hit = np.flatnonzero((unit >= 0) & (inside >= 0))
                    where.append(inside[hit])
                    who.append(unit[hit])
                at, units = np.concatenate(where), np.concatenate(who)
                for d in [*range(-WIDTH, 0), *range(1, WIDTH + 1)]:
                    p = at + d
                    ok = (p >= 0) & (p < len(bucket))
                    ok[ok] = words.doc[p[ok]] == words.doc[at[ok]]
                    held.append(units[ok] * BUCKETS + bucket[p[ok]])
                    size += len(held[-1])
                if size > 4_000_000:
                    yield fold(held)
                    held, size = [], 0
        yield fold(held)

    cells = df.select(F.col(text).alias("x")).mapInPandas(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    return cells.select(F.floor(F.col("cell") / BUCKETS).alias("unit"), (F.col("cell") % BUCKETS).alias("bucket"), "n")


def skip_gram(counts: np.ndarray, rounds: int = 120, negative: float = 1.0, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Word and context vectors of the skip-gram objective with negative sampling, on aggregated counts.

    Each pair's gradient is the expected one over all its samples, so the
    result does not depend on the order of the texts.
    """
    rng = np.random.default_rng(seed)
    w = rng.normal(0, 0.1, (counts.shape[0], LENGTH))
    c = rng.normal(0, 0.1, (counts.shape[1], LENGTH))
    per_word = np.maximum(counts.sum(1, keepdims=True), 1)
    share = counts.sum(0) / max(1.0, counts.sum())
    pos = counts / per_word  # every word weighs the same, so that rare ones are learned too
    neg = negative * np.broadcast_to(share, counts.shape)
    state = [[np.zeros_like(w), np.zeros_like(w)], [np.zeros_like(c), np.zeros_like(c)]]
    for step in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(w @ c.T, -30, 30)))
        g = neg * p - pos * (1 - p)
        for x, grad, (m, v) in ((w, g @ c + 1e-4 * w, state[0]), (c, g.T @ w / max(1, len(w)) * 50 + 1e-4 * c, state[1])):
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            x -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return w, c


def fitting(df: DataFrame, found: DataFrame, text: str = "text", fit: float = -3.0) -> DataFrame:
    """``(form, word)`` of the links whose contexts fit.

    Vectors are trained for about ``TOGETHER`` links at a time, in a task each;
    a link's form and word are always together.
    """
    groups = max(1, -(-found.count() // TOGETHER))
    linked = found.select("form", "word", (F.crc32("form") % groups).alias("part"))
    ends = linked.select("part", F.explode(F.array("form", "word")).alias("name")).distinct()
    known = sorted(r["name"] for r in ends.select("name").distinct().toLocalIterator())
    if not known:
        return linked.select("form", "word")
    numbers = df.sparkSession.createDataFrame(pd.DataFrame({"name": known, "unit": range(len(known))}), "name string, unit long")
    cells = ends.join(numbers, "name").join(contexts(df, known, text), "unit").select(F.col("part").alias("group"), "name", "bucket", "n")

    def judge(own: pd.DataFrame, cells: pd.DataFrame) -> pd.DataFrame:
        names = sorted({*own["form"], *own["word"]})
        number = {u: i for i, u in enumerate(names)}
        counts = np.zeros((len(names), BUCKETS))
        counts[cells["name"].map(number).to_numpy(dtype=np.int64), cells["bucket"].to_numpy(dtype=np.int64)] = cells["n"]
        w, c = skip_gram(counts)
        kept = []
        for form, word in zip(own["form"], own["word"], strict=True):
            x = counts[number[form]]
            score = float((x * (c @ w[number[word]])).sum() / x.sum()) if x.sum() else 0.0
            if score >= fit:
                kept.append((form, word))
        return pd.DataFrame(kept, columns=["form", "word"])

    return linked.groupBy("part").cogroup(cells.groupBy("group")).applyInPandas(judge, "form string, word string")


def learn(df: DataFrame, text: str = "text", fit: float = -3.0) -> Lexicon:
    """The lexicon of a corpus: frequent words and the misread forms whose contexts fit theirs.

    ``fit`` is the least mean score of the word's vector with the contexts of
    the form; unrelated words score far below. Counts are over distinct texts:
    a form isn't sound because the text that holds it was delivered many times.
    """
    df = distinct_texts(df, text)
    units = checkpointed(count_units(df, text))
    kept = checkpointed(fitting(df, checkpointed(links(units)), text, fit))
    misread = {r["form"]: r["word"] for r in kept.toLocalIterator()}
    frequent = units.where(F.col("n") >= LEAST).join(kept.select(F.col("form").alias("unit")), "unit", "left_anti")
    centres = sorted({_centre(u) for u in misread if u[0] in "<>"})
    pair = F.col("unit").rlike("^[<>]")
    centre = F.when(F.col("unit").startswith("<"), F.substring("unit", 3, 1)).otherwise(F.substring("unit", 2, 1))
    pairs = frozenset(r["unit"] for r in frequent.where(pair & centre.isin(centres)).select("unit").toLocalIterator())

    def hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            signed = [any(c in _KATA_MIS for c in u) for u in b["unit"]]
            own = np.array([word_hash(u) for u in b["unit"]], dtype="<u8")
            yield pd.DataFrame({"signed": [False, True], "h": [own[~np.array(signed, dtype=bool)].tobytes(), own[np.array(signed, dtype=bool)].tobytes()]})

    words: dict[bool, list[bytes]] = {False: [], True: []}
    for r in frequent.where(~pair & ~F.col("unit").rlike("^[\\x00-\\x7f]")).select("unit").mapInPandas(hashes, "signed boolean, h binary").toLocalIterator():
        words[r["signed"]].append(bytes(r["h"]))
    plain, signed = (np.sort(np.frombuffer(b"".join(words[k]), dtype="<u8")) for k in (False, True))
    return Lexicon(plain, signed, misread, pairs)


def _centre(unit: str) -> str:
    """The kanji of a pair, without its neighbour."""
    return unit[2] if unit[0] == "<" else unit[1]


def _among(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which keys are in the sorted ``known``."""
    if not len(known):
        return np.zeros(len(keys), dtype=bool)
    return known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys


class Reader:
    """Finds and corrects misread words by a lexicon."""

    def __init__(self, lexicon: Lexicon):
        self._sound, self._signed, self.misread, self.pairs = lexicon
        self.kanji = {u for u in self.misread if u[0] in "<>"}
        chars = {_centre(u) for u in self.kanji}
        forms = [len(u) for u in self.misread if u[0] >= "\x80"]
        self._lengths = range(min(forms, default=1), max(forms, default=0) + 1)
        self.suspect = re.compile("[" + "".join(sorted(chars)) + "]") if chars else None
        self._kata = lru_cache(maxsize=100_000)(self._katakana)
        self._latin = np.array(sorted(word_hash(u) for u in self.misread if u[0] < "\x80"), dtype=np.uint64)
        self._pairs = np.array(sorted(pair_key(u) for u in self.kanji), dtype=np.int64)
        self._sides = np.array(sorted(pair_key(u) for u in self.pairs if len(u) == 3), dtype=np.int64)

    def _is_word(self, piece: str) -> bool:
        known = self._signed if any(c in _KATA_MIS for c in piece) else self._sound
        return bool(_among(np.array([word_hash(piece)], dtype=np.uint64), known)[0])

    def _katakana(self, run: str) -> str:
        """The run with its misread words put right; the run itself if it has none or can't be read as words."""
        if run in self.misread:
            return self.misread[run]
        n = len(run)
        if not any(run[s : s + k] in self.misread for k in self._lengths for s in range(n - k + 1)):
            return run  # nothing to put right
        if not any(c in _KATA_MIS for c in run) and self._is_word(run):
            return run
        best: list[tuple[int, int, str] | None] = [(0, 0, "")] + [None] * n  # pieces, -corrected, text
        for e in range(1, n + 1):
            for s in range(max(0, e - LONGEST), e - 1):
                head = best[s]
                if head is None:
                    continue
                piece = run[s:e]
                right = self.misread.get(piece)
                if right is None and not self._is_word(piece):
                    continue
                option = (head[0] + 1, head[1] + (right is not None), head[2] + (right or piece))
                if best[e] is None or option[0] < best[e][0]:
                    best[e] = option
        end = best[n]
        return end[2] if end and end[1] else run

    def _kanji_fixed(self, flow: str, i: int) -> str | None:
        """The kanji meant at ``i`` if one neighbour speaks for it and the other not against it."""
        left = "<" + flow[i - 1 : i + 1] if i else "<"
        right = ">" + flow[i : i + 2]
        l, r = self.misread.get(left), self.misread.get(right)
        if l and (r or right not in self.pairs):
            return l[2]
        return r[1] if r and left not in self.pairs else None

    def suspects(self, words: Batch) -> np.ndarray:
        """Texts of a batch that may hold a misread word: all that do, and few others."""
        docs = [words.numbered, words.doc[words.latin & _among(words.hash, self._latin)]]
        left, right = _among(words.left, self._pairs), _among(words.right, self._pairs)
        against = (left & _among(words.right, self._sides)) | (right & _among(words.left, self._sides))
        docs.append(words.at_doc[(left | right) & ~against])
        odd = np.flatnonzero((words.run == 3) & (words.end - words.start >= 2) & ~_among(words.hash, self._sound))
        if len(odd):
            key, first, back = np.unique(words.hash[odd], return_index=True, return_inverse=True)
            wrong = np.array([(lambda t: self._kata(t) != t)(words.text(int(odd[k]))) for k in first])
            docs.append(words.doc[odd[wrong[back]]])
        return np.unique(np.concatenate(docs))

    def corrections(self, flow: str) -> list[tuple[int, int, str]]:
        """``(start, end, right)`` of every misread stretch."""
        out = []
        for m in _TOKEN.finditer(flow):
            t = m[0]
            if t[0] < "\x80":
                w = t.lower()
                if len(t) >= 3 and w in self.misread and (m.start() == 0 or flow[m.start() - 1] not in "\\{}_^$&;#/"):
                    right = self.misread[w]
                    right = right.capitalize() if t[0].isupper() and not t.isupper() else right.upper() if t.isupper() else right
                    out.append((m.start(), m.end(), right))
            elif any("ァ" <= x <= "ー" for x in t):
                right = self._kata(t)
                if right != t:
                    out.append((m.start(), m.end(), right))
        if self.suspect:
            for m in self.suspect.finditer(flow):
                right = self._kanji_fixed(flow, m.start())
                if right and right != m[0]:
                    out.append((m.start(), m.end(), right))
        for m in _NUMBER.finditer(flow):
            out.append((m.start(), m.end(), "".join(DIGITS.get(c, c) for c in m[0])))
        return sorted(out)


def hyphenated(lines: list[str], pages: list[bool]) -> bool:
    """Whether a Latin word is split over a line end, a page number or a short line between its halves or not."""
    kept = "\n".join(x for x, p in zip(lines, pages, strict=True) if not p)
    return bool(_SPLIT_WORD.search(kept) or _SPLIT_OVER.search(kept))


def fold_title(line: str) -> str:
    """A line or title without white space, numbers and chapter at its ends, and with easily misread glyphs made one."""
    x = "".join(line.split())
    before = None
    while before != x and x:
        before = x
        if m := _HEAD_FIRST.match(x):
            x = x[m.end() :]
        if x and x[-1] in _HEAD_ENDS:
            core = len(x.rstrip(_HEAD_SIGNS))
            x = x[:core] + _HEAD_LAST.sub("", x[core:])
    return x.translate(_FOLDED)


_FOLD = {k: v for k, v in KATAKANA.items() if k not in "ンシ"} | {k: v for k, v in KANJI.items() if v not in KANJI or KANJI[v] != k} | {"l": "1", "I": "1", "O": "0", "S": "5"}
_FOLDED = str.maketrans(_FOLD)
_HYPHEN_END = re.compile(rf"[{HYPHENS}][ 　\t]*\r?\n")


#: Titles that go to the workers; more meet the lines in a join.
MOST_TITLES = 200_000
#: Places a file's titles stand in when texts meet them in a join.
SALTS = 64


def titles(files: DataFrame) -> DataFrame:
    """``(file, head)``: the folded title and short title of each file."""
    fold = F.pandas_udf(lambda s: s.map(lambda x: fold_title(x) if x else None), "string")
    both = files.select(F.col("source_file").alias("file"), F.explode(F.array("title", "short_title")).alias("t")).where(F.col("t").isNotNull() & F.col("file").isNotNull())
    return both.select("file", fold("t").alias("head")).where(F.length("head") >= 4).distinct()


def _hashes_of(heads: list[str]) -> np.ndarray:
    """The hash of each string."""
    size = np.cumsum([0, *map(len, heads)])
    return _hashes(np.frombuffer("".join(heads).encode("utf-32-le", "surrogatepass"), dtype="<u4"), size[:-1], size[1:])


class Heads:
    """Which strings may be folded titles: by their sorted hashes, or beyond ``MOST_TITLES`` by a filter of fixed size."""

    def __init__(self, hashes: np.ndarray | None, bits: bytes, least: int, most: int):
        self._hashes, self._bits, self.least, self.most = hashes, bits, least, most

    @classmethod
    def of(cls, heads: list[str]) -> Heads:
        return cls(np.unique(_hashes_of(heads)), b"", min(map(len, heads), default=4), max(map(len, heads), default=0))

    @classmethod
    def filtered(cls, heads: DataFrame) -> Heads:
        bit = F.pandas_udf(lambda s: pd.Series(cls._bit(_hashes_of(list(s)))), "long")
        size = heads.agg(F.min(F.length("head")).alias("least"), F.max(F.length("head")).alias("most")).first()
        return cls(None, _filter(heads, bit("head")), size["least"] or 4, size["most"] or 0)

    @staticmethod
    def _bit(hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(32)).astype(np.int64) % FILTER

    def may_be(self, hashes: np.ndarray) -> np.ndarray:
        """Which hashes are those of a title, or by the filter may be."""
        if self._hashes is not None:
            return _among(hashes, self._hashes)
        bit = self._bit(hashes)
        return (np.frombuffer(self._bits, dtype=np.uint8)[bit >> 3] >> (bit & 7).astype(np.uint8) & 1).astype(bool)

    def found(self, texts: list[str | None]) -> Iterator[tuple[int, str]]:
        """The number of each text that has a line that may fold to a title, with the folded line, for every such line.

        Lines are folded on arrays, many texts at once. Only those that begin
        or end as what stands beside a title does are folded one by one.
        """
        t = _tables()
        for rows, held in runs_of(texts):
            codes = np.frombuffer("".join(x + "\n" for x in held).encode("utf-32-le", "surrogatepass"), dtype="<u4")
            solid, at = ~t.space[codes], np.flatnonzero(codes == 10)
            end = np.cumsum(solid)[at]
            start = np.concatenate([[0], end[:-1]])
            codes = codes[solid]
            line = np.flatnonzero(end - start >= self.least)
            dressed = t.first[codes[start[line]]] | t.last[codes[end[line] - 1]]
            plain, dressed = line[~dressed], line[dressed]
            plain = plain[end[plain] - start[plain] <= self.most]
            folded = t.fold[codes]
            plain = plain[self.may_be(_hashes(folded, start[plain], end[plain]))]
            met = [(k, folded[start[k] : end[k]].tobytes().decode("utf-32-le", "surrogatepass")) for k in plain.tolist()]
            bare = [(k, h) for k in dressed.tolist() if self.least <= len(h := fold_title(codes[start[k] : end[k]].tobytes().decode("utf-32-le", "surrogatepass"))) <= self.most]
            met += [x for x, ok in zip(bare, self.may_be(_hashes_of([h for _, h in bare])), strict=True) if ok]
            bounds = np.cumsum([len(x) + 1 for x in held])
            of = np.searchsorted(bounds, at[[k for k, _ in met]], side="right") if met else []
            yield from ((rows[i], h) for i, (_, h) in zip(of, met, strict=True))


def _known_titles(heads: DataFrame) -> dict[str, set[str]] | None:
    """Titles by file, or None if there are more than ``MOST_TITLES``."""
    rows = heads.limit(MOST_TITLES + 1).collect()
    if len(rows) > MOST_TITLES:
        return None
    out: dict[str, set[str]] = {}
    for r in rows:
        out.setdefault(r["file"], set()).add(r["head"])
    return out


def scan(df: DataFrame, lexicon: Lexicon, known: dict[str, set[str]] | None, heads: Heads, key: str = "id", text: str = "text", file: str = "source_file") -> DataFrame:
    """``(key, noise, file, head)``: the kinds of noise of each text.

    A running head is a line whose folded form is a folded title of the file.
    With ``known`` titles it is found here. Without them every line that may
    be one of ``heads`` comes out as a possible head, with its folded form.
    """
    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(lexicon)
        for b in batches:
            out = []
            keys, texts, files = list(b["k"]), list(b["x"]), list(b["f"])
            flows: list[str | None] = list(texts)
            for i, x in enumerate(texts):
                if not x:
                    continue
                if "\n" in x:
                    lines = x.split("\n")
                    pages = page_lines(lines)
                    hyphen = bool(_HYPHEN_END.search(x))
                    if any(pages):
                        out.append((keys[i], "page_number", files[i], None))
                    if any(pages) or hyphen:
                        flows[i] = _flow(x)
                    if hyphen and hyphenated(lines, pages):
                        out.append((keys[i], "hyphen", files[i], None))
            for i, head in set(heads.found(texts)):
                if known is None:
                    out.append((keys[i], "header", files[i], head))
                elif head in known.get(files[i], ()):
                    out.append((keys[i], "header", files[i], None))
            for rows, words in batches_of(flows):
                for d in reader.suspects(words).tolist():
                    i = rows[d]
                    if reader.corrections(_flow(texts[i])):
                        out.append((keys[i], "misread", files[i], None))
            yield pd.DataFrame(out, columns=["k", "noise", "f", "head"])

    rows = df.select(F.col(key).alias("k"), F.col(text).alias("x"), F.col(file).alias("f"))
    return rows.mapInPandas(run, f"k {kind}, noise string, f string, head string").select(F.col("k").alias(key), "noise", F.col("f").alias("file"), "head")


def noise(df: DataFrame, files: DataFrame, lexicon: Lexicon | None = None, key: str = "id", text: str = "text", file: str = "source_file") -> DataFrame:
    """``(key, noise)``: the kinds of scanning noise of each row, once each.

    Null and blank texts have none. Without a lexicon it is learned from
    ``df``. Titles go to the workers if there are at most ``MOST_TITLES`` of
    them; beyond that a filter of fixed size goes there, and the few lines it
    lets through meet the titles by file and folded form, in rows of a few
    dozen bytes spread by both.
    """
    lexicon = lexicon or learn(df, text)
    heads = titles(files)
    known = _known_titles(heads)
    if known is None:
        heads = checkpointed(heads)
    found = scan(df, lexicon, known, Heads.filtered(heads) if known is None else Heads.of([h for own in known.values() for h in own]), key, text, file)
    if known is not None:
        return found.select(key, "noise").distinct()
    found = checkpointed(found)
    met = found.where(F.col("head").isNotNull()).join(heads, ["file", "head"], "left_semi")
    return found.where(F.col("head").isNull()).select(key, "noise").union(met.select(key, "noise")).distinct()


def tidy(text: str, heads: set[str]) -> str:
    """The text without furniture, split words and wrapped Japanese lines joined."""
    if "\n" not in text:
        return text
    lines = text.split("\n")
    pages = page_lines(lines)
    if heads or any(pages):
        text = "\n".join(x for x, p in zip(lines, pages, strict=True) if not p and not (heads and fold_title(x) in heads))
    if _HYPHEN_END.search(text):
        text = _SPLIT_WORD.sub(r"\1\2 ", text)
    return _JP_BREAK.sub("", text)


def corrected(flow: str, reader: Reader) -> str:
    """The text with its misread words put right."""
    out, at = [], 0
    for s, e, right in reader.corrections(flow):
        if s >= at:
            out.extend((flow[at:s], right))
            at = e
    return "".join(out) + flow[at:]


def reflow(flow: str) -> str:
    """Wrapped Latin lines joined and blanks at line ends removed; blank lines, list entries and headings keep their lines."""
    flow = re.sub(r"(?<=[A-Za-z,;)])[ \t]*\n[ \t]*(?=[a-z(])", " ", flow)
    return re.sub(r"(?<![ \t　])[ \t　]+(?=\n|\Z)", "", flow)


def repair_text(text: str, reader: Reader, heads: set[str]) -> str:
    """One text without scanning noise."""
    return reflow(corrected(tidy(text, heads), reader))


def repaired(df: DataFrame, files: DataFrame, lexicon: Lexicon | None = None, key: str = "id", text: str = "text", file: str = "source_file") -> DataFrame:
    """``(key, file, text, repaired)`` of every row: ``repaired`` has no scanning noise; null text stays null."""
    lexicon = lexicon or learn(df, text)
    kind = dict(df.dtypes)[key]
    heads = titles(files)
    wanted = heads.groupBy(F.col("file").alias("f")).agg(F.collect_set("head").alias("heads"))  # two per file at most
    rows = df.select(F.col(key).alias("k"), F.col(file).alias("f"), F.col(text).alias("x"))
    if heads.limit(MOST_TITLES + 1).count() <= MOST_TITLES:
        rows = rows.join(F.broadcast(wanted), "f", "left")
    else:  # a file may hold a third of the texts: each of its titles stands in SALTS places
        places = wanted.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = rows.withColumn("s", F.pmod(F.xxhash64("k"), F.lit(SALTS))).join(places.hint("merge"), ["f", "s"], "left").drop("s")  # else broadcast by the size before the places

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(lexicon)
        for b in batches:
            owned = [set(h) if h is not None else set() for h in b["heads"]]
            headed = {i for i, h in Heads.of(list(set().union(*owned))).found(list(b["x"])) if h in owned[i]}
            texts = [None if x is None else tidy(x, owned[i] if i in headed else set()) for i, x in enumerate(b["x"])]
            for rows, words in batches_of(texts):
                for d in reader.suspects(words).tolist():
                    texts[rows[d]] = corrected(texts[rows[d]], reader)
            done = [None if x is None else reflow(x) for x in texts]
            yield pd.DataFrame({"k": b["k"], "f": b["f"], "x": b["x"], "r": done})

    out = rows.mapInPandas(run, f"k {kind}, f string, x string, r string")
    return out.select(F.col("k").alias(key), F.col("f").alias(file), F.col("x").alias(text), F.col("r").alias("repaired"))

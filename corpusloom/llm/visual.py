"""One consistent form for text that looks the same.

The text column's Arrow buffers become one array of code points for the whole
batch. A lookup table over all code points gives each one's expansion: its
compatibility decomposition, with look-alike letters, spaces and hyphens
mapped to one member and invisible characters to nothing. Expansion offsets
place the results, combining marks are put in order and composed, all by array
operations on the batch; no string is handled by itself.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import checkpointed

# Letters of other alphabets that have the shape of a Latin letter.
LOOK_ALIKE = {
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "Ѕ": "S", "І": "I", "Ј": "J", "Ԛ": "Q", "Ԝ": "W", "Ү": "Y",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "ԁ": "d", "һ": "h", "ԛ": "q", "ԝ": "w", "ү": "y",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "ο": "o", "ν": "v", "ϲ": "c", "Ϲ": "C", "ϳ": "j", "Ϳ": "J", "օ": "o", "ս": "u", "ց": "g", "հ": "h", "ո": "n", "Օ": "O", "Ս": "U", "Լ": "L", "ɑ": "a", "ɡ": "g",
}
# Characters that look like a hyphen.
HYPHENS = "‐‑‒−⁃˗﹣－"
# Characters that show nothing, beside the format characters and variation selectors.
INVISIBLE = "͏ᅟᅠ឴឵ㅤﾠ"
#: Sound marks that stand beside a kana look like those that combine with it.
_BESIDE = {0x309B: "゙", 0x309C: "゚"}


def _expansion(code: int) -> str | None:
    """What ``code`` becomes before composition; None for itself."""
    c = chr(code)
    if 0xD800 <= code < 0xE000:
        return None
    kind = unicodedata.category(c)
    if kind == "Cf" or c in INVISIBLE or 0xFE00 <= code <= 0xFE0F or 0xE0100 <= code <= 0xE01EF or 0x180B <= code <= 0x180F:
        return ""
    if code in _BESIDE:
        return _BESIDE[code]
    full = "".join(LOOK_ALIKE.get(x, "-" if x in HYPHENS else " " if unicodedata.category(x) == "Zs" else x) for x in unicodedata.normalize("NFKD", c))
    full = "".join(x for x in full if unicodedata.category(x) != "Cf" and x not in INVISIBLE)
    return None if full == c else full


class Tables:
    """Lookup tables over all code points, built once per process from the Unicode data and the fixed values."""

    def __init__(self) -> None:
        top = sys.maxunicode + 1
        self.length = np.ones(top, dtype=np.uint8)
        self.offset = np.zeros(top, dtype=np.uint32)
        self.mapped = np.zeros(top, dtype=bool)
        self.rank = np.zeros(top, dtype=np.uint8)  # combining class
        pool: list[int] = []
        pairs: dict[tuple[int, int], int] = {}
        for code in range(top):
            if 0x3400 <= code < 0xA000 or 0x17000 <= code < 0x1B000 or 0x20000 <= code < 0x2F800 or 0x30000 <= code < 0xE0000 or 0xE0200 <= code:
                continue  # unified ideographs and private use have no decomposition
            c = chr(code)
            self.rank[code] = unicodedata.combining(c)
            e = _expansion(code)
            if e is not None:
                self.mapped[code], self.length[code], self.offset[code] = True, len(e), len(pool)
                pool.extend(map(ord, e))
            d = unicodedata.decomposition(c)
            if d and not d.startswith("<") and len(parts := d.split()) == 2 and unicodedata.normalize("NFC", c) == c:
                pairs[int(parts[0], 16), int(parts[1], 16)] = code
        for code in range(0xAC00, 0xD7A4):  # composed Hangul: lead and vowel, then tail
            at = code - 0xAC00
            if at % 28 == 0:
                pairs[0x1100 + at // 588, 0x1161 + at % 588 // 28] = code
            else:
                pairs[code - at % 28, 0x11A7 + at % 28] = code
        self.pool = np.array(pool, dtype=np.uint32)
        keys = np.array([a << 21 | b for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys)
        self.pair_key = keys[order]
        self.pair_code = np.array(list(pairs.values()), dtype=np.uint32)[order]
        self.second = np.zeros(top, dtype=bool)  # may be the second of a pair
        self.second[[b for _, b in pairs]] = True


@cache
def tables() -> Tables:
    return Tables()


def _running(starts: np.ndarray) -> np.ndarray:
    """For each position the last one at which ``starts`` holds."""
    return np.maximum.accumulate(np.where(starts, np.arange(len(starts)), 0))


def canonical_codes(codes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of a batch in their consistent form, and the new bounds of its rows.

    ``bounds`` has one more entry than there are rows; marks never combine
    across rows.
    """
    t = tables()
    size = t.length[codes].astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(size)])
    out = np.empty(ends[-1], dtype=np.uint32)
    mapped = t.mapped[codes]
    plain = ~mapped
    out[ends[:-1][plain]] = codes[plain]
    if mapped.any():
        n = size[mapped]
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        out[np.repeat(ends[:-1][mapped], n) + within] = t.pool[np.repeat(t.offset[codes[mapped]].astype(np.int64), n) + within]
    bounds = ends[bounds]
    rank = t.rank[out]
    if not t.second[out].any() and not rank.any():
        return out, bounds
    first = np.zeros(len(out) + 1, dtype=bool)
    first[bounds] = True
    while True:  # neighbouring marks in canonical order; few texts need any round
        swap = np.flatnonzero((rank[:-1] > rank[1:]) & (rank[1:] > 0) & ~first[1:-1])
        if not len(swap):
            break
        swap = swap[np.concatenate([[True], np.diff(swap) > 1])]
        out[swap], out[swap + 1] = out[swap + 1].copy(), out[swap].copy()
        rank = t.rank[out]
    while len(out):  # each round composes the first fitting mark of every base
        at = np.flatnonzero(t.second[out] & ~first[: len(out)])
        if not len(at):
            break
        starter = (rank == 0) | first[: len(out)]
        base = _running(starter)
        base_of = base[at - 1]  # the base before this one, also where this is itself no mark
        before = rank[at - 1]
        open_ = np.where(base_of == at - 1, True, (before < rank[at]) & (rank[at] > 0)) & (rank[base_of] == 0)
        key = out[base_of].astype(np.int64) << 21 | out[at]
        k = np.minimum(np.searchsorted(t.pair_key, key), len(t.pair_key) - 1)
        fits = open_ & (t.pair_key[k] == key)
        at, base_of, k = at[fits], base_of[fits], k[fits]
        if not len(at):
            break
        one = np.concatenate([[True], np.diff(base_of) > 0])
        # a base that is itself taken as a second this round must wait
        one &= ~np.isin(base_of, at)
        at, base_of, k = at[one], base_of[one], k[one]
        out[base_of] = t.pair_code[k]
        keep = np.ones(len(out), dtype=bool)
        keep[at] = False
        moved = np.concatenate([[0], np.cumsum(keep)])
        out, bounds = out[keep], moved[bounds]
        rank = t.rank[out]
        first = np.zeros(len(out) + 1, dtype=bool)
        first[bounds] = True
    return out, bounds


def canonical_array(column: pa.Array) -> pa.Array:
    """An Arrow string array in its consistent form; null stays null."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None and len(offsets) else np.zeros(0, np.uint8)
    if not len(raw):
        return column.cast(pa.string())
    chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    codes = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), dtype="<u4")
    out, bounds = canonical_codes(codes, chars[offsets - offsets[0]])
    width = 1 + (out > 0x7F).astype(np.int64) + (out > 0x7FF) + (out > 0xFFFF)
    ends = np.concatenate([[0], np.cumsum(width)])[bounds]
    encoded = out.astype("<u4").tobytes().decode("utf-32-le").encode("utf-8")
    valid = None if not column.null_count else pa.array(column.is_valid().to_numpy(zero_copy_only=False)).buffers()[1]
    return pa.LargeStringArray.from_buffers(len(column), pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(encoded), valid, column.null_count).cast(pa.string())


def canonical(text: str) -> str:
    """One text in its consistent form."""
    return canonical_array(pa.array([text]))[0].as_py()


def with_canonical(df: DataFrame, text: str = "text", out: str = "canonical", keep_text: bool = True) -> DataFrame:
    """``df`` with ``out``, the consistent form of ``text``; null stays null.

    Everything else passes through untouched. An existing column ``out`` is
    replaced.
    """
    df = df.drop(out) if out != text else df
    fields = [f for f in df.schema if keep_text or f.name != text]
    names = [f.name for f in fields]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    same = out == text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = canonical_array(batch.column(batch.schema.get_field_index(text)))
            columns = [done if same and n == text else batch.column(batch.schema.get_field_index(n)) for n in names]
            yield pa.RecordBatch.from_arrays(columns + ([] if same else [done]), names=names + ([] if same else [out]))

    return df.mapInArrow(run, schema if same else f"{schema}, `{out}` string" if schema else f"`{out}` string")


def _classes(df: DataFrame, key: str, text: str) -> DataFrame:
    """``(form, raw, key)``: hashes of the consistent form and of the text, for rows with visible text."""
    rows = df.where(F.col(text).isNotNull() & F.col(key).isNotNull()).select(key, text, F.md5(text).alias("raw"))
    forms = with_canonical(rows, text, "canonical", keep_text=False).where(F.trim("canonical", F.lit(" \t\r\n")) != "")
    return forms.select(F.md5("canonical").alias("form"), "raw", key).distinct()


def same_looking(left: DataFrame, right: DataFrame, left_key: str, right_key: str, text: str = "text") -> DataFrame:
    """``(left_key, right_key)`` of rows whose texts look the same but are different character sequences.

    Forms meet as distinct ``(form, text)`` classes, so copies of a text,
    however many, are one row in the join; only classes that differ in their
    text are expanded to keys. Blank and null texts make no case.
    """
    # hashes and keys alone, read twice below: materialised so that each text is brought to its form once
    a, b = checkpointed(_classes(left, left_key, text)), checkpointed(_classes(right, right_key, text))
    ca, cb = a.select("form", "raw").distinct(), b.select("form", F.col("raw").alias("other")).distinct()
    pairs = ca.join(cb, "form").where(F.col("raw") != F.col("other"))
    return pairs.join(a, ["form", "raw"]).join(b.withColumnRenamed("raw", "other"), ["form", "other"]).select(left_key, right_key).distinct()

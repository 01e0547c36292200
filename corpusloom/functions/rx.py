"""Regular expressions that mean the same on the JVM as in Python.

Java needs ``(?U)`` for Unicode-aware ``\\d`` and ``\\s`` and ``(?d)`` so that only
``\\n`` ends a line. ``replace_all`` also turns Python's ``\\1`` into Java's ``$1``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: the characters that count as Japanese.
JP = "[ぁ-んァ-ヴー一-龠々〆〤]"
#: Unicode's white space.
WHITE = "".join(map(chr, [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def canonical(pattern: str, ignore_case: bool = False) -> str:
    """``pattern`` with the flags that give it Python's meaning on the JVM."""
    return ("(?dUi)" if ignore_case else "(?dU)") + pattern


def matches_start(text: Column, pattern: str, ignore_case: bool = False) -> Column:
    """True where ``re.match`` would find ``pattern`` at the start. Null gives null."""
    return text.rlike(canonical(rf"\A(?:{pattern})", ignore_case))


def searches(text: Column, pattern: str, ignore_case: bool = False) -> Column:
    """True where ``re.search`` would find ``pattern``. Null gives null."""
    return text.rlike(canonical(pattern, ignore_case))


def replace_all(text: Column, pattern: str, replacement: str, ignore_case: bool = False) -> Column:
    """``re.sub`` over a column; ``replacement`` is in Python's notation."""
    java = re.sub(r"\\(\d)", r"$\1", replacement.replace("$", "\\$"))
    return F.regexp_replace(text, canonical(pattern, ignore_case), java)


def strip(text: Column) -> Column:
    """``str.strip``: white space of any script off both ends."""
    return F.btrim(text, F.lit(WHITE))


def rstrip(text: Column) -> Column:
    """``str.rstrip``."""
    return F.rtrim(text, F.lit(WHITE))


def lines(text: Column) -> Column:
    """``str.split('\\n')``: trailing empty lines are kept."""
    return F.split(text, "\n", -1)


def unlines(parts: Column) -> Column:
    """Lines joined again."""
    return F.array_join(parts, "\n")


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with ``name`` computed once a row, however often it is referred to later.

    The optimizer puts a projection's expression in place of each reference to
    it and moves filters below; it does neither across a generator.
    """
    return df.select(*[c for c in df.columns if c != name], F.explode(F.array(value)).alias(name))


def occurrences(text: Column, one_of: str) -> Column:
    """How many characters of ``text`` are in ``one_of``."""
    return F.length(text) - F.length(F.translate(text, one_of, ""))

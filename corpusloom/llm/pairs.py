"""Defective question and answer pairs: empty, refusal, copy, wrong language, truncated.

A multi-label linear classifier reads hashed character n-grams and features of
the pair, all computed for a batch at once on code-point arrays:

* ``answer``: n-grams of the whole answer, for refusals;
* ``short``: n-grams of what is left of an answer without labels, tags, quotes
  and signs, if that is little, for answers that are empty;
* ``added``: n-grams of the answer that the question hasn't, for copies;
* ``ends``: n-grams at the answer's end, for broken ones;
* pair features: how much of the question is given back and how much is added,
  how familiar the answer's n-grams are among sound answers, what share of it
  is in a script or, by character profiles, a language other than the
  question's, how it ends.

It is trained on a bounded sample of the pairs at hand and on defects made from
them: answers cut off, questions given back, answers swapped for ones in
another language, refusals and placeholders. The sample holds defects itself:
its pairs weigh little as sound examples at first, those that one model finds
defective are left out of the next one's, and likely refusals among them become
examples of refusals. Scores are calibrated on defects made from wordings that
the calibrated model hasn't seen, at the prior ``PRIOR`` of each defect.
"""

from __future__ import annotations

import random
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm import wordings

DEFECTS = ("empty", "refusal", "copy", "language", "truncated")
#: Pairs of the table used for training.
SAMPLE = 4000
#: Hashed n-grams by kind, and the bits of the table of familiar ones.
SIZES = {"answer": 1 << 16, "short": 1 << 13, "added": 1 << 15, "ends": 1 << 14}
FAMILIAR = 1 << 18
#: Share of pairs that each defect is assumed to have when scores are calibrated.
PRIOR = 0.03
#: Weight, when scores are calibrated, of the sound pairs that are made to look like defects.
HARD = 0.25

# Signs that end a sentence or its quotation, and pairs of brackets.
_END = "。．.!?！？」』）)】］]”\"’'}>"
_BRACKETS = ["()", "（）", "「」", "『』", "[]", "{}", "“”", "【】"]
_LABEL = re.compile(r"^\s*(?:answer|response|reply|a|q|question|回答|返答|答え?|答|質問|問い?|回复|答案|답변)\s*[:：.．]\s*", re.IGNORECASE)
_WRAP = re.compile(r"<[^<>]*>|&(?:[a-z]+|#\d+);|\"\w+\"\s*:")
_VALUE = re.compile(r"^(?:約|およそ|ほぼ|about|approximately|approx\.?|~)?\s*[-+±−]?\d[\d.,]*\s*[^\s。、]{0,6}(?:\s*(?:です|である|とされている|程度|以下|以上|くらい))?\s*[。.]?$", re.IGNORECASE)
_BULLET = re.compile(r"^\s*(?:[・•●○*-]|[(（]?\d{1,2}[)）.．])\s*")
_ASKED = re.compile(r"[一-龠ァ-ヶー]{1,8}語(?:で|に|へ|の文|訳)|[英和中独仏西露韓伊]訳|訳し|翻訳|翻译|用.{1,4}[语文]|translat|\bin(?:to)? (?:[A-Z][a-z]+(?:ish|ese|an|ic|ch)|French|German|Thai|Greek|Hindi|Hebrew)\b", re.IGNORECASE)

DENSE = ("one", "length", "nothing", "hollow", "covered", "added", "added_share", "added_digits", "same", "little_added", "familiar", "familiar_added", "unfamiliar", "brief", "foreign", "foreign_main", "foreign_asked", "asked", "ended", "value", "plain", "plain_long", "unbalanced", "open_json", "fence", "spoke", "built", "shorter", "hanging", "sole_entry", "kana_end", "kanji_end", "kata_end", "latin_end", "digit_end", "sign_end")
_D = {name: i for i, name in enumerate(DENSE)}
#: What each output reads: kinds of n-grams, and features of the pair.
READS = {
    "empty": (("short",), ("one", "length", "nothing", "hollow")),
    "refusal": (("answer", "ends"), ("one", "length", "added_digits", "familiar_added", "unfamiliar", "brief", "value")),
    "copy": (("added",), ("one", "covered", "added", "added_share", "added_digits", "same", "little_added")),
    "language": ((), ("one", "foreign", "foreign_main", "foreign_asked", "asked")),
    "truncated": (("ends",), ("one", "length", "ended", "value", "plain", "plain_long", "unbalanced", "open_json", "fence", "spoke", "built", "shorter", "hanging", "sole_entry", "kana_end", "kanji_end", "kata_end", "latin_end", "digit_end", "sign_end")),
}


class Grams(NamedTuple):
    """Hashed n-grams of many texts: the row, the bucket and the value of each."""

    rows: np.ndarray
    cols: np.ndarray
    vals: np.ndarray


class Features(NamedTuple):
    """What the classifier reads of many pairs."""

    n: int
    grams: dict[str, Grams]
    dense: np.ndarray


class _Kinds(NamedTuple):
    script: np.ndarray
    names: list[str]
    end: np.ndarray
    solid: np.ndarray


@lru_cache(maxsize=1)
def _kinds() -> _Kinds:
    """Script of every letter of the basic plane (0: none), by its Unicode name, and other properties of characters."""
    script = np.zeros(0x10000, dtype=np.uint8)
    names = ["", "LATIN", "CJK", "KANA"]
    number = {"": 0, "LATIN": 1, "CJK": 2, "HIRAGANA": 3, "KATAKANA": 3, "KATAKANA-HIRAGANA": 3, "HALFWIDTH": 0, "FULLWIDTH": 0, "IDEOGRAPHIC": 2}
    for o in range(0x41, 0xFFDD):
        c = chr(o)
        if (0x4E00 <= o <= 0x9FFF) or (0x3400 <= o <= 0x4DBF):
            script[o] = 2
        elif 0xAC00 <= o <= 0xD7A3:
            script[o] = number.setdefault("HANGUL", len(number) + 20)
        elif c.isalpha() or unicodedata.category(c) in ("Mn", "Mc"):
            first = unicodedata.name(c, " ").split(" ")[0]
            if first == "COMBINING":
                continue
            script[o] = number.setdefault(first, len(number) + 20)
    end = np.zeros(0x10000, dtype=bool)
    end[[ord(c) for c in _END]] = True
    solid = np.array([chr(o).isalnum() for o in range(0x10000)])
    return _Kinds(script, names, end, solid)


class _Joined(NamedTuple):
    """Code points of many texts, each followed by a zero, the row of each and the bounds of the rows."""

    codes: np.ndarray
    row: np.ndarray
    start: np.ndarray
    stop: np.ndarray


def _join(texts: list[str]) -> _Joined:
    joined = "\0".join([*(x.replace("\0", " ") for x in texts), ""])
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    stop = np.flatnonzero(codes == 0)
    start = np.concatenate([[0], stop[:-1] + 1])
    row = np.repeat(np.arange(len(texts)), stop - start + 1)
    return _Joined(np.minimum(codes, 0xFFFF), row, start, stop)


def _hash(codes: np.ndarray, n: int, salt: int) -> np.ndarray:
    """A 32-bit hash of the ``n`` code points from each place on."""
    size = max(0, len(codes) - n + 1)
    with np.errstate(over="ignore"):
        h = np.full(size, salt * 40503 + n, dtype=np.uint32)
        for i in range(n):
            h = (h ^ codes[i : size + i].astype(np.uint32)) * np.uint32(0x85EBCA6B)
            h ^= h >> np.uint32(13)
        h *= np.uint32(0xC2B2AE35)
        return h ^ (h >> np.uint32(16))


def _grams(j: _Joined, n: int, salt: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place, row and hash of the n-grams that lie inside a row."""
    h = _hash(j.codes, n, salt)
    last = j.row[n - 1 :] if n > 1 else j.row
    inside = (j.row[: len(h)] == last[: len(h)]) & (j.codes[n - 1 : n - 1 + len(h)] != 0)
    at = np.flatnonzero(inside)
    return at, j.row[at], h[at]


def _plain(text: str | None) -> str:
    return unicodedata.normalize("NFKC", text).lower().strip() if text else ""


def _core(answer: str) -> str:
    """What is left of an answer without labels, tags and entities: letters and digits, words parted by a blank."""
    x = answer
    while True:
        cut = _WRAP.sub(" ", _LABEL.sub("", x, count=1))
        if cut == x:
            break
        x = cut
    return re.sub(r"[\W_]+", " ", unicodedata.normalize("NFKC", x).lower()).strip()


#: Answers up to this many characters may turn out to be empty although they aren't blank; longer ones of letters aren't placeholders.
_FEW, _CORE = 120, 26


def _list_end(end: str) -> tuple[float, float, float, float] | None:
    """``(built, shorter, hanging, sole)`` of the last entry of a list, if the text ends in one without a full stop."""
    rows = [x for x in end.split("\n") if x.strip()]
    if not rows or not _BULLET.match(rows[-1]):
        return None
    last = _BULLET.sub("", rows[-1]).rstrip()
    if last.endswith(tuple(_END)):
        return None
    others = [_BULLET.sub("", x).strip() for x in rows[:-1] if _BULLET.match(x)]
    sizes = [len(x) for x in others]
    shorter = bool(sizes) and len(last) < 0.6 * sum(sizes) / len(sizes)
    joints = [c for c in "のをにへでと" if others and all(c in x for x in others)]
    built = bool(joints) and all(c in last and len(last) - last.rindex(c) > 2 for c in joints)  # like the entries before it
    alike = bool(last) and any(x[-2:] == last[-2:] for x in others)
    hanging = not last or bool(re.search(r"[のをにがはとでもへや、,・(（]$", last))
    return float(built or alike), float(shorter), float(hanging), float(not others)


def features(pairs: list[tuple[str | None, str | None]], familiar: np.ndarray | None = None) -> Features:
    """The n-grams and features of every pair; ``familiar`` marks n-grams of sound answers."""
    n = len(pairs)
    kinds = _kinds()
    raw = [a or "" for _, a in pairs]
    qs, as_ = [_plain(q) for q, _ in pairs], [_plain(a) for a in raw]
    d = np.zeros((n, len(DENSE)), dtype=np.float32)
    d[:, _D["one"]] = 1
    q, a = _join(qs), _join(as_)
    size = (a.stop - a.start).astype(np.float32)
    d[:, _D["length"]] = np.log1p(size) / 6
    digits = (a.codes >= 48) & (a.codes <= 57)
    folded = a._replace(codes=np.where(digits, 48, a.codes))
    grams: dict[str, Grams] = {}

    # the whole answer
    rows, cols = [], []
    for k in (2, 3, 4):
        _, r, h = _grams(folded, k, 1)
        rows.append(r)
        cols.append(h % np.uint32(SIZES["answer"]))
    r, c = np.concatenate(rows), np.concatenate(cols)
    per = np.bincount(r, minlength=n)
    grams["answer"] = Grams(r, c, (4.0 / np.sqrt(np.maximum(9.0, per)))[r].astype(np.float32))

    # what the question hasn't
    def keyed(j: _Joined, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at, row, h = _grams(j, k, 2)
        solid = kinds.solid[j.codes[at]].copy()
        for i in range(1, k):
            solid &= kinds.solid[j.codes[at + i]]
        return at[solid], row[solid], (row[solid].astype(np.int64) << 32) | h[solid]

    solid_q, solid_a = _squeezed(q, kinds), _squeezed(a, kinds)
    rows, cols = [], []
    for k in (1, 2, 3):
        _, rq, kq = keyed(solid_q, k)
        at, ra, ka = keyed(solid_a, k)
        own = np.unique(kq)
        new = ~_among(ka, own)
        if k == 1:
            code = solid_a.codes[at[new]]
            d[:, _D["added_digits"]] = np.minimum(3, np.bincount(ra[new], weights=(code >= 48) & (code <= 57), minlength=n)) / 3
            continue
        rows.append(ra[new])
        cols.append(((ka[new] & 0xFFFFFFFF) % SIZES["added"]).astype(np.int64))
        if k == 2:
            mine = np.unique(ka)
            back = np.bincount((own[_among(own, mine)] >> 32).astype(np.int64), minlength=n)
            asked = np.bincount((own >> 32).astype(np.int64), minlength=n)
            given = np.bincount(ra[new], minlength=n)
            have = np.bincount(ra, minlength=n)
            covered = back / np.maximum(1, asked)
            d[:, _D["covered"]] = covered
            d[:, _D["added"]] = np.log1p(given) / 5
            d[:, _D["added_share"]] = given / np.maximum(1, have)
            d[:, _D["same"]] = (covered >= 0.9) & (given <= 1) & (asked > 2)
            d[:, _D["little_added"]] = (covered >= 0.6) & (given <= 0.5 * asked) & (asked > 2)
            # a digit of another number is another content, whatever the rest
            _, _, numbers = keyed(solid_a, 2)
    r, c = np.concatenate(rows), np.concatenate(cols)
    grams["added"] = Grams(r, c, np.full(len(r), 0.15, dtype=np.float32))

    # how familiar the answer is, apart from what it has from the question
    if familiar is not None:
        at, r, h = _grams(folded, 5, 3)
        known = familiar[h % np.uint32(FAMILIAR)]
        hq = q._replace(codes=np.where((q.codes >= 48) & (q.codes <= 57), 48, q.codes))
        _, rq, h_q = _grams(hq, 5, 3)
        new = ~_among((r.astype(np.int64) << 32) | h, np.unique((rq.astype(np.int64) << 32) | h_q))
        total, seen = np.bincount(r[new], minlength=n), np.bincount(r[new], weights=known[new], minlength=n)
        d[:, _D["familiar_added"]] = seen / np.maximum(1, total)
        d[:, _D["familiar"]] = np.log1p(seen) / 5
        d[:, _D["unfamiliar"]] = np.log1p(total - seen) / 5
    d[:, _D["brief"]] = size <= 24

    # what is left of short answers
    rows, cols = [], []
    few = [i for i, x in enumerate(raw) if len(x) <= _FEW]
    cores = {i: _core(raw[i]) for i in few}
    for i, core in cores.items():
        d[i, _D["nothing"]] = not core
        d[i, _D["hollow"]] = 0 < len(core) <= 2 and not core.isdigit() and core.isascii()
    little = [i for i, core in cores.items() if 0 < len(core) <= _CORE]
    if little:
        j = _join([f"^{re.sub(r'[0-9]+', '0', cores[i])}$" for i in little])
        number = np.array(little)
        for k in (1, 2, 3, 4):
            _, r, h = _grams(j, k, 4)
            rows.append(number[r])
            cols.append(h % np.uint32(SIZES["short"]))
        whole = _row_hash(j)
        rows.append(number)
        cols.append(whole % np.uint32(SIZES["short"]))
    r = np.concatenate([*rows, np.empty(0, dtype=np.int64)]).astype(np.int64)
    c = np.concatenate([*cols, np.empty(0, dtype=np.uint32)]).astype(np.int64)
    per = np.bincount(r, minlength=n)
    grams["short"] = Grams(r, c, (2.5 / np.sqrt(np.maximum(4.0, per)))[r].astype(np.float32))

    # languages
    d[:, _D["foreign"]], d[:, _D["foreign_main"]] = _foreign(pairs)
    asked = np.array([bool(x) and bool(_ASKED.search(x)) for x, _ in pairs])
    d[:, _D["asked"]] = asked
    d[:, _D["foreign_asked"]] = d[:, _D["foreign_main"]] * asked

    # the end
    rows, cols, vals = [], [], []
    some = a.stop > a.start
    last = np.where(some, a.codes[np.maximum(a.stop - 1, 0)], 0)
    for k in (1, 2, 3, 4, 5, 6):
        ok = np.flatnonzero(a.stop - a.start >= k)
        h = np.full(len(ok), k * 7919, dtype=np.uint32)
        with np.errstate(over="ignore"):
            for i in range(k):
                h = (h ^ folded.codes[a.stop[ok] - k + i].astype(np.uint32)) * np.uint32(0x85EBCA6B)
                h ^= h >> np.uint32(13)
        rows.append(ok)
        cols.append(h % np.uint32(SIZES["ends"]))
        vals.append(np.full(len(ok), 0.4, dtype=np.float32))
    ended = kinds.end[last] & some
    d[:, _D["ended"]] = ended
    script = kinds.script[last]
    hiragana = (last >= 0x3041) & (last <= 0x3096)
    digit_end = (last >= 48) & (last <= 57)
    for name, is_ in (("kana_end", hiragana), ("kanji_end", script == 2), ("kata_end", (script == 3) & ~hiragana), ("latin_end", script == 1), ("digit_end", digit_end), ("sign_end", ~ended & ~kinds.solid[last])):
        d[:, _D[name]] = is_ & some & ~ended
    off = np.zeros(n)
    for o, c in _BRACKETS:
        off += np.abs(np.bincount(a.row, weights=(a.codes == ord(o)).astype(float) - (a.codes == ord(c)), minlength=n))
    d[:, _D["unbalanced"]] = np.minimum(2, off) / 2
    stops = np.isin(a.codes, [0x3002, 0x21, 0x3F, 0xFF01, 0xFF1F])
    stops[:-1] |= (a.codes[:-1] == 46) & ((a.codes[1:] == 32) | (a.codes[1:] == 10))
    spoke = np.bincount(a.row, weights=stops, minlength=n) > 0
    for i in np.flatnonzero(some & ~ended):
        x = raw[i].rstrip()
        value = len(x) <= 40 and bool(_VALUE.match(x))
        d[i, _D["value"]] = value
        entry = _list_end(x) if "\n" in x else None
        if entry:
            d[i, _D["built"]], d[i, _D["shorter"]], d[i, _D["hanging"]], d[i, _D["sole_entry"]] = entry
            continue
        d[i, _D["plain"]] = not value
        d[i, _D["plain_long"]] = not value and len(x) > 25
        d[i, _D["spoke"]] = not value and spoke[i]
    r, c, v = np.concatenate(rows), np.concatenate(cols).astype(np.int64), np.concatenate(vals)
    v[d[r, _D["value"]] > 0] = 0  # a bare value ends as values do
    grams["ends"] = Grams(r, c, v)
    for i in np.flatnonzero((off > 0) & some):
        d[i, _D["open_json"]] = raw[i].lstrip()[:1] in "{["
    for i, x in enumerate(raw):
        if "```" in x:
            d[i, _D["fence"]] = x.count("```") % 2
    return Features(n, grams, d)


def _squeezed(j: _Joined, kinds: _Kinds) -> _Joined:
    """The rows with letters and digits only."""
    keep = kinds.solid[j.codes] | (j.codes == 0)
    row = j.row[keep]
    codes = j.codes[keep]
    stop = np.flatnonzero(codes == 0)
    return _Joined(codes, row, np.concatenate([[0], stop[:-1] + 1]), stop)


def _among(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which keys are in the sorted ``known``."""
    if not len(known):
        return np.zeros(len(keys), dtype=bool)
    return known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys


def _row_hash(j: _Joined) -> np.ndarray:
    """A hash of each whole row."""
    with np.errstate(over="ignore"):
        x = j.codes.astype(np.uint64) + np.uint64(1)
        place = (np.arange(len(x)) - j.start[j.row]).astype(np.uint64) + np.uint64(3)
        x = x * place * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
        total = np.add.reduceat(x * np.uint64(0xBF58476D1CE4E5B9), j.start)
        return (total >> np.uint64(32)).astype(np.uint32)


# --- languages ------------------------------------------------------------

_PROFILE = 1 << 12


@lru_cache(maxsize=1)
def _profiles() -> tuple[list[str], np.ndarray]:
    """Languages of the Latin script and the log-probability of each hashed character 3-gram in each."""
    kinds = _kinds()
    names, rows = [], []
    for name, lines in wordings.LANGUAGES.items():
        j = _join([f" {x.lower()} " for x in lines])
        if (kinds.script[j.codes] == 1).sum() * 2 < len(j.codes):
            continue
        count = np.full(_PROFILE, 0.05)
        for k in (2, 3):
            _, _, h = _grams(j, k, 5)
            np.add.at(count, h % np.uint32(_PROFILE), 1)
        names.append(name)
        rows.append(np.log(count / count.sum()))
    return names, np.array(rows).T


def _segments(j: _Joined) -> np.ndarray:
    """The number of the sentence or line each code point belongs to, across all rows."""
    c = j.codes
    cut = np.isin(c, [0, 10, 0x3002, 0xFF01, 0xFF1F, 0x21, 0x3F])
    cut[:-1] |= (c[:-1] == 46) & np.isin(c[1:], [0, 10, 32])
    return np.concatenate([[0], np.cumsum(cut)[:-1]])


def _foreign(pairs: list[tuple[str | None, str | None]]) -> tuple[np.ndarray, np.ndarray]:
    """Of each answer the share, by letters, of its sentences in another script or language than the question's, and whether that is most of it.

    Quotations count with the sentence they stand in. Sentences of few letters
    that may be names, units or ideographs of either language don't count.
    """
    n = len(pairs)
    kinds = _kinds()
    quoted = re.compile(r"[“\"「『][^”\"」』]*[”\"」』]")

    def bare(x: str | None) -> str:
        if not x:
            return ""
        rest = quoted.sub("", x)
        return rest if any(c.isalpha() for c in rest) or rest == x else x

    j, q = _join([bare(a) for _, a in pairs]), _join([x or "" for x, _ in pairs])
    wide = 64

    def main_of(j: _Joined, unit: np.ndarray, units: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Letters of each unit, its main script and its letters by script; kana takes the ideographs beside it."""
        s = kinds.script[j.codes].astype(np.int64)
        count = np.bincount(unit * wide + s, minlength=units * wide).reshape(units, wide)
        count[:, 0] = 0
        kana = (count[:, 3] > 0) & (count[:, 3] * 8 >= count[:, 2])
        count[kana, 3] += count[kana, 2]
        count[kana, 2] = 0
        return count.sum(1), count.argmax(1), count

    asked_letters, asked, _ = main_of(q, q.row, n)
    seg = _segments(j)
    units = int(seg[-1]) + 1 if len(seg) else 0
    letters, script, count = main_of(j, seg, units)
    owner = np.zeros(units, dtype=np.int64)
    owner[seg] = j.row
    blanks = np.bincount(seg, weights=j.codes == 32, minlength=units)
    weak = (letters < 2) | ((script == 2) & (letters < 8)) | ((script == 1) & ((letters < 12) | (blanks < 2)))
    other = (script != asked[owner]) & (count[np.arange(units), asked[owner]] < 0.25 * letters)
    other[(script == 3) & (asked[owner] == 2) & (letters < 5)] = False
    # Latin script in both: the profiles decide
    both = (script == 1) & (asked[owner] == 1) & ~weak
    if both.any():
        names, logp = _profiles()
        low = j._replace(codes=np.where((j.codes >= 65) & (j.codes <= 90), j.codes + 32, j.codes))
        low_q = q._replace(codes=np.where((q.codes >= 65) & (q.codes <= 90), q.codes + 32, q.codes))

        def scores(j: _Joined, unit: np.ndarray, units: int, wanted: np.ndarray) -> np.ndarray:
            out = np.zeros((units, len(names)))
            for k in (2, 3):
                at, _, h = _grams(j, k, 5)
                ok = wanted[unit[at]]
                at, h = at[ok], h[ok] % np.uint32(_PROFILE)
                for m in range(len(names)):
                    out[:, m] += np.bincount(unit[at], weights=logp[h, m], minlength=units)
            return out

        own = scores(low, seg, units, both)
        rows = np.zeros(n, dtype=bool)
        rows[owner[both]] = True
        of_question = scores(low_q, q.row, n, rows)
        known, best = of_question.argmax(1)[owner], own.argmax(1)
        lead = own.max(1) - own[np.arange(units), known]
        apart = of_question.max(1)[owner] - of_question[owner, best]  # a question that may be in either says nothing
        other[both] = ((lead > 0.35 * letters) & (apart > 0.2 * asked_letters[owner]))[both]
    fair = ~weak & (asked_letters[owner] > 0)
    total = np.bincount(owner[fair], weights=letters[fair], minlength=n)
    away = np.bincount(owner[fair & other], weights=letters[fair & other], minlength=n)
    share = away / np.maximum(1, total)
    return share, share > 0.5


# --- synthetic defects ----------------------------------------------------


def copy(rng: random.Random, q: str, held: bool | None = None) -> str:
    """The question given back in one of many forms."""
    b = re.sub(r"[。.?？!！]+$", "", q.strip())
    tells = sorted((f for f in wordings.FORMS_TELL if f), key=len, reverse=True)
    n = b
    reworded = b
    for form in tells:
        if b.endswith(form):
            n = b[: -len(form)]
            reworded = n + rng.choice(wordings.part_of(wordings.FORMS_TELL, held))
            break
    else:
        for form in sorted(wordings.FORMS_ASK, key=len, reverse=True):
            if b.endswith(form):
                n = b[: -len(form)]
                reworded = (n + rng.choice(wordings.part_of(wordings.FORMS_ASK, held))) if form not in ("ですか",) else n + rng.choice(["ですか", "でしょうか", "か", "なのか", "ですか教えてください"])
                break
    kind = rng.random()
    if kind < 0.6:
        return rng.choice(wordings.part_of(wordings.COPIES, held)).format(q=q, b=b, n=re.sub(r"は何$|何を$", "", n) or b)
    if kind < 0.78:
        frame = rng.choice(["{}", "{}", "{}", "質問: {}", "{}ということですね", "回答: {}", "「{}」"])
        return frame.format(reworded) + rng.choice(["", "?", "。", "？"])
    k = rng.randrange(6)
    if k == 0:
        return q.upper()
    if k == 1:
        return q.lower()
    if k == 2:
        return re.sub(r"[のはをが、]", "", q, count=rng.randint(1, 3))
    if k == 3:
        return "".join(chr(ord(c) + 0xFEE0) if "!" <= c <= "~" else c for c in q)
    if k == 4:
        at = rng.randint(1, max(1, len(b) - 1))
        return rng.choice([b[:at] + " " + b[at:], b[:at] + "、" + b[at:], b[:at] + "\n" + b[at:]])
    words = b.split(" ")
    if len(words) > 3:
        at = rng.randint(1, len(words) - 1)
        return " ".join(words[at:] + words[:at])
    at = max(b.find("は"), b.find("の"), b.find("で"))
    return (b[at + 1 :] + "、" + b[: at + 1] if at > 1 else b) + "。"


def cut(rng: random.Random, a: str) -> str | None:
    """The answer broken off before its end, or None if it is too short to tell."""
    if _VALUE.match(a) or len(a) < 16:
        return None
    rows = a.rstrip().split("\n")
    if len(rows) > 2 and _BULLET.match(rows[-1]) and rng.random() < 0.8:
        k = rng.randint(2, len(rows) - 1)
        entry = rows[k]
        joints = [m.end() for m in re.finditer(r"[のをにとは、]", entry)]
        at = rng.choice(joints) if joints and rng.random() < 0.5 else rng.randint(1, max(1, len(entry) - 2))
        if entry[at - 1 : at] in "。.":
            return None
        return "\n".join(rows[:k] + [entry[:at]])
    stops = [m.end() for m in re.finditer(r"[。！？!?]|\.(?=\s|$)", a)]
    for _ in range(8):
        at = rng.randint(min(14, len(a) - 2), len(a) - 2)
        part = a[:at].rstrip()
        if at not in stops and part[-1:] not in "。.!?！？)）」』" and not _VALUE.match(part):
            return part + rng.choice(["", "", "", "", "", "、", "また", "(", "。なお、", "。例えば", "…", "。その理由は", "。第二に"] if "。" in a else ["", "", "", " and", ", which", " (", ". However,"])
    return None


class Made(NamedTuple):
    """Pairs made for training: which are sound pairs of the sample, and the labels of all."""

    pairs: list[tuple[str | None, str | None]]
    labels: np.ndarray
    real: np.ndarray


def training(good: list[tuple[str, str]], refused: list[tuple[str, str]] = (), held: bool | None = None, seed: int = 5, about: list[tuple[str, str]] | None = None) -> Made:
    """The sound pairs of the sample, defective ones made from them (or from ``about``), and sound ones that look like defects."""
    rng = random.Random(seed)
    out: list[tuple[str | None, str | None]] = list(good)
    real = len(out)
    labels: list[str] = [""] * len(out)
    good = good if about is None else about

    def add(q: str | None, a: str | None, name: str = "") -> None:
        out.append((q, a))
        labels.append(name)

    kinds = _kinds()
    foreign: dict[str, list[str]] = {k: list(v) for k, v in wordings.LANGUAGES.items()}
    kana = re.compile("[ぁ-んァ-ヴ]")
    whole = [(q, a) for q, a in good if len(a) > 24 and not a.lstrip().startswith("{") and a.rstrip().endswith(tuple(_END)) and q.isascii() == a.isascii() and bool(kana.search(q)) == bool(kana.search(a))]
    plenty = {True: [a for q, a in whole if q.isascii()], False: [a for q, a in whole if not q.isascii()]}
    for _, a in good:
        s = np.bincount(kinds.script[_join([a]).codes], minlength=64)
        s[0] = 0
        if s.sum() > 30 and s.max() > 0.9 * s.sum():
            name = {1: "en", 2: "zh"}.get(int(s.argmax()), "")
            if name and len(foreign[name]) < 300:
                foreign[name].append(a)
        elif s.sum() > 30 and s[3] * 6 > s.sum() and s[2] + s[3] > 0.9 * s.sum() and len(foreign["ja"]) < 300:
            foreign["ja"].append(a)
    terms = sorted({t for q, _ in good for t in re.findall(r"[ァ-ヴー一-龠]{2,10}|[A-Za-z]{3,12}", q)}) or ["装置", "温度"]
    latin = [t for t in terms if t.isascii()]
    names = list(foreign)
    pick = good or [("これは何ですか?", "これは例です。")]
    for _ in range(max(600, len(good) // 4)):
        q, a = rng.choice(pick)
        long = plenty[q.isascii()]
        add(q, wordings.hollow(rng, held), "empty")
        add(q, wordings.hollow(rng, held), "empty")
        add(q, rng.choice(wordings.SHORT))
        add(q, rng.choice(wordings.SHORT) if rng.random() < 0.2 else rng.choice(["{}", "{}。", "{}です。", "{}である", "{}など", "{}と{u}", "A: {}"]).format(rng.choice(terms), u=rng.choice(terms)))
        for _ in range(2):
            topic = rng.choice([rng.choice(terms), rng.choice(terms) + "の" + rng.choice(terms), ""])
            add(q, wordings.refusal(rng, topic, held, rng.choice(["", "the ", "the "]) + rng.choice(latin) + rng.choice(["", " of this unit", f" of the {rng.choice(latin)}"]) if latin else ""), "refusal")
        t, u, v = rng.choice(terms), rng.choice(terms), rng.choice(wordings.CANT_VERBS)
        cant = rng.choice([c for c in wordings.CANT if c.isascii() == q.isascii()]).format(t=t, u=u, v=v, w=rng.choice(["replace", "measure", "stop", "open"]))
        add(q, rng.choice([cant, cant, cant + rng.choice(long) if long else cant, (rng.choice(long) if long else "") + cant]))
        add(q, rng.choice([h for h in wordings.HEDGES if h.isascii() == q.isascii()]) + rng.choice([x for x in wordings.BRIEF if x.isascii() == q.isascii()]).format(t=t, u=u, v=v))
        add(q, rng.choice([x for x in wordings.BRIEF if x.isascii() == q.isascii()]).format(t=t, u=u, v=v))
        if long:
            add(q, rng.choice([h for h in wordings.HEDGES if h.isascii() == q.isascii()]) + rng.choice(long))
        if len(q) >= 8:
            add(q, copy(rng, q, held), "copy")
            b = re.sub(r"(?:は何ですか|ですか|ますか|でしょうか|いくらですか|いくらか|いくつか|か|を?説明してください|を?述べよ|を?教えてください)?[。.?？!！]*$", "", q.strip())
            add(q, b + rng.choice(["は", "は、", "として", "は主に"]) + rng.choice(["{}と{}です。", "{}です。", "{}による。", "{}を使う。", "{}の{}である。", "{}と{}が挙げられます。"]).format(t, u) if not q.isascii() else f"It is the {t}, because of the {u}.")
            value = rng.choice(["{} mm です。", "約 {} %", "{} °C である。", "{}", "は {} kW", "、{} 回"]).format(rng.choice([rng.randint(1, 900), round(rng.random() * 50, 1)]))
            add(q, rng.choice([b + value, b + "、" + rng.choice(terms) + "による。", "はい、" + b + "ます。", "いいえ、" + b + "ません。", b + "については、" + rng.choice(long) if long else b + value, q + "\n" + rng.choice(long) if long else b + value, rng.choice(wordings.COPIES[:16]).format(q=q, b=b, n=b) + "\n回答: " + (rng.choice(long) if long else value)]))
        part = cut(rng, a)
        if part:
            add(q, '{"answer": "' + part if rng.random() < 0.08 else part, "truncated")
        if a.endswith("。") and rng.random() < 0.05:
            add(q, a[:-1])
        if rng.random() < 0.03:
            add(q, '{"answer": "' + a + '"}')
        s = np.bincount(kinds.script[_join([q]).codes], minlength=64)
        s[0] = 0
        main = {1: "en", 2: "zh"}.get(int(s.argmax()), "ja") if not s[3] else "ja"
        other = rng.choice([k for k in names if k != main])
        if held is not None and main == "ja":
            other = rng.choice([k for k in wordings.part_of(names, held) if k != main] or [other])
        text = " ".join(rng.choice(foreign[other]) for _ in range(rng.randint(1, 3)))
        if not _ASKED.search(q):
            add(q, rng.choice(["", "", "", "はい。", "いいえ。", "回答: "]) + text, "language")
            if rng.random() < 0.4 and other in wordings.ASKS:
                ja, en = wordings.ASKS[other]
                add(rng.choice([f"{q}{ja}で答えてください。", f"{ja}で説明してください: {q}", f"{q} Answer in {en}.", f"{q}{ja}に訳してください。", f"{q}({ja}で)"]), text)
            if long and rng.random() < 0.5:
                quoted = rng.choice(foreign[rng.choice(["en", "zh", "de"])])
                add(q, rng.choice([f"{rng.choice(long)}文献には「{quoted}」とある。", f"“{quoted}” とされる。{rng.choice(long)}"]) if main == "ja" else a)
    for q, a in refused:
        add(q, a, "refusal")
    y = np.zeros((len(out), len(DEFECTS)), dtype=np.float32)
    for i, name in enumerate(labels):
        if name:
            y[i, DEFECTS.index(name)] = 1
    return Made(out, y, np.arange(len(out)) < real)


# --- the model ------------------------------------------------------------


class Model(NamedTuple):
    """Weights of each output by kind of n-gram and of the pair's features, familiar n-grams, and the calibration of each score."""

    grams: dict[tuple[str, str], np.ndarray]
    dense: np.ndarray
    familiar: np.ndarray
    scale: np.ndarray
    shift: np.ndarray


def familiar_grams(answers: list[str], least: int = 3, most: int = 500) -> np.ndarray:
    """Marks of the 5-grams that occur in ``least`` of the answers or more."""
    count = np.zeros(FAMILIAR, dtype=np.uint16)
    for i in range(0, len(answers), most):
        j = _join([re.sub(r"[0-9]", "0", _plain(x)) for x in answers[i : i + most]])
        _, r, h = _grams(j, 5, 3)
        slot = np.unique((r.astype(np.int64) << 32) | (h % np.uint32(FAMILIAR))) & 0xFFFFFFFF
        np.add.at(count, slot, 1)
    return count >= least


def scores(grams: dict[tuple[str, str], np.ndarray], dense: np.ndarray, x: Features) -> np.ndarray:
    """The score of each pair for each defect."""
    out = (x.dense @ dense).astype(np.float64)
    for (name, kind), w in grams.items():
        g = x.grams[kind]
        out[:, DEFECTS.index(name)] += np.bincount(g.rows, weights=w[g.cols] * g.vals, minlength=x.n)
    return out


def fit(x: Features, y: np.ndarray, weight: np.ndarray, rounds: int = 60) -> tuple[dict[tuple[str, str], np.ndarray], np.ndarray]:
    """Logistic regression per defect over what the defect reads."""
    grams: dict[tuple[str, str], np.ndarray] = {}
    dense = np.zeros((len(DENSE), len(DEFECTS)))
    for k, name in enumerate(DEFECTS):
        kinds, own = READS[name]
        cols = [_D[f] for f in own]
        xd = x.dense[:, cols].astype(np.float64)
        ws = [np.zeros(len(cols)), *(np.zeros(SIZES[kind]) for kind in kinds)]
        state = [(np.zeros_like(w), np.zeros_like(w)) for w in ws]
        target = y[:, k]
        per = weight * np.where(target > 0, 2.0, 1.0) * (y[:, :k].sum(1) == 0)  # the first defect in order counts
        per = per / per.sum()
        for step in range(1, rounds + 1):
            s = xd @ ws[0]
            for kind, w in zip(kinds, ws[1:], strict=True):
                g = x.grams[kind]
                s += np.bincount(g.rows, weights=w[g.cols] * g.vals, minlength=x.n)
            d = (1 / (1 + np.exp(-np.clip(s, -30, 30))) - target) * per
            grads = [xd.T @ d]
            for kind in kinds:
                g = x.grams[kind]
                grads.append(np.bincount(g.cols, weights=d[g.rows] * g.vals, minlength=SIZES[kind]))
            for w, grad, (m, v) in zip(ws, grads, state, strict=True):
                grad = grad + 2e-6 * w
                m += 0.1 * (grad - m)
                v += 0.05 * (grad * grad - v)
                w -= 0.14 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.95**step)) + 1e-7)
        dense[cols, k] = ws[0]
        for kind, w in zip(kinds, ws[1:], strict=True):
            grams[name, kind] = w.astype(np.float32)
    return grams, dense


def calibrate(score: np.ndarray, y: np.ndarray, real: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Platt's ``(scale, shift)`` for each defect, with defects weighing ``PRIOR`` and made sound pairs, which look like defects on purpose, ``HARD``."""
    scale, shift = np.ones(len(DEFECTS)), np.zeros(len(DEFECTS))
    for k in range(len(DEFECTS)):
        own = y[:, :k].sum(1) == 0
        s, t, r = score[own, k], y[own, k], real[own]
        if not t.any() or t.all():
            continue
        made = (t == 0) & ~r
        w = np.where(t > 0, PRIOR / t.sum(), np.where(r, (1 - PRIOR - HARD) / max(1, r.sum()), HARD / max(1, made.sum())))
        a, b = 1.0, -2.0
        for _ in range(60):
            p = 1 / (1 + np.exp(-np.clip(a * s + b, -30, 30)))
            e, h = w * (p - t), w * p * (1 - p) + 1e-9
            g = np.array([(e * s).sum() + 1e-4 * (a - 1), e.sum()])
            m = np.array([[(h * s * s).sum() + 1e-4, (h * s).sum()], [(h * s).sum(), h.sum() + 1e-9]])
            step = np.clip(np.linalg.solve(m, g), -1, 1)
            a, b = max(0.05, a - step[0]), b - step[1]
        scale[k], shift[k] = a, b
    return scale, shift


def _features(pairs: list[tuple[str | None, str | None]], familiar: np.ndarray | None) -> Features:
    """``features`` of any number of pairs, some at a time."""
    parts = [features(pairs[i : i + 2000], familiar) for i in range(0, len(pairs), 2000)] or [features([])]
    first = np.concatenate([[0], np.cumsum([p.n for p in parts])])
    grams = {k: Grams(np.concatenate([p.grams[k].rows + f for p, f in zip(parts, first[:-1], strict=True)]), np.concatenate([p.grams[k].cols.astype(np.intp) for p in parts]), np.concatenate([p.grams[k].vals for p in parts])) for k in SIZES}
    return Features(int(first[-1]), grams, np.concatenate([p.dense for p in parts]))


def train(sample: list[tuple[str | None, str | None]], trusts: tuple[float, ...] = (0.1, 0.4)) -> Model:
    """A model learned from the sound pairs of a sample and what is made of them.

    In each turn, with growing trust in the sample, either half is judged by a
    model learned from the other, as a model knows its own examples by heart.
    What scores like nine tenths of the defects made from wordings unknown to
    that model is doubted, at most a tenth of the pairs for each defect, and
    left out from then on; what scores like the better half of such refusals
    becomes an example of them. The last model learns from all wordings and
    takes the calibration of one that knows three quarters of them.
    """
    good = [(q, a) for q, a in sample if q and a and a.strip()]
    half = np.arange(len(good)) % 2
    keep = np.ones(len(good), dtype=bool)
    refused = np.zeros(len(good), dtype=bool)
    k = DEFECTS.index("refusal")

    def of(which: np.ndarray) -> list[tuple[str, str]]:
        return [p for p, w in zip(good, which, strict=True) if w]

    for trust in trusts if len(good) > 1 else ():
        kept, sure = keep.copy(), refused.copy()
        for h in (0, 1):
            mine, learned = half == h, (half != h) & keep
            familiar = familiar_grams([a for _, a in of(learned)])
            made = training(of(learned), of(refused & ~mine), False, 5)
            part, d = fit(_features(made.pairs, familiar), made.labels, np.where(made.real, trust, 1.0), 40)
            unseen = training([], (), True, 6, about=of(learned))
            raw = scores(part, d, _features(unseen.pairs, familiar))
            s = scores(part, d, _features(of(mine), familiar))
            plain = np.quantile(s, 0.9, axis=0)
            like = np.array([np.quantile(raw[unseen.labels[:, i] > 0, i], 0.1) for i in range(len(DEFECTS))])
            kept[mine] = ((s < like) | (s <= plain)).all(1)
            middle = np.quantile(raw[unseen.labels[:, k] > 0, k], 0.5)
            sure[mine] = (s[:, k] > max(middle, plain[k])) & (s[:, 0] < like[0])
        keep, refused = kept, sure
    clean = of(keep) or good
    familiar = familiar_grams([a for _, a in clean])
    taught = of(keep & (half == 0)) or clean
    made = training(taught, of(refused & (half == 0)), False, 5)
    known = familiar_grams([a for _, a in taught], 2)
    part, d = fit(_features(made.pairs, known), made.labels, np.ones(len(made.pairs)))
    judged = training(of(keep & (half == 1)), (), True, 6, about=clean)
    scale, shift = calibrate(scores(part, d, _features(judged.pairs, known)), judged.labels, judged.real)
    made = training(clean, of(refused), None, 7)
    part, d = fit(_features(made.pairs, familiar), made.labels, np.ones(len(made.pairs)))
    return Model(part, d, familiar, scale, shift)


def classify(model: Model, pairs: list[tuple[str | None, str | None]]) -> list[str | None]:
    """Each pair's defect, the first in order that the model finds likelier than not, or None."""
    out: list[str | None] = []
    for i in range(0, len(pairs), 2000):
        x = features(pairs[i : i + 2000], model.familiar)
        hit = scores(model.grams, model.dense, x) * model.scale + model.shift >= 0
        out.extend(DEFECTS[int(h.argmax())] if h.any() else None for h in hit)
    return out


def train_on(df: DataFrame, question: str = "question", answer: str = "answer", key: str = "pair_id", sample: int = SAMPLE) -> Model:
    """A model trained on at most ``sample`` pairs of the table, those with the least hash of their key."""
    rows = df.select(F.xxhash64(key).alias("h"), question, answer).orderBy("h").limit(sample).collect()
    return train([(r[question], r[answer]) for r in rows])


def defects(df: DataFrame, model: Model | None = None, key: str = "pair_id", question: str = "question", answer: str = "answer") -> DataFrame:
    """``(key, defect)`` of every defective row; sound rows are left out.

    A null answer is empty. A null or empty question makes no copy and no
    wrong language. Without a model one is trained on ``df``.
    """
    model = model or train_on(df, question, answer, key)
    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = classify(model, list(zip(b["q"], b["a"], strict=True)))
            out = pd.DataFrame({"k": b["k"], "defect": found})
            yield out[out["defect"].notna()]

    rows = df.select(F.col(key).alias("k"), F.col(question).alias("q"), F.col(answer).alias("a"))
    return rows.mapInPandas(run, f"k {kind}, defect string").select(F.col("k").alias(key), "defect")

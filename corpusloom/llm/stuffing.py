"""Keyword-stuffed pages and lists of links, tags or products.

Two measures of a page are combined. Its suffix automaton gives the maximal
substrings that recur often for the page's length: which characters they
cover, how much the densest one covers alone, and which clauses say one of
them three times or more and consist of it to three tenths or more. A pass
over the page's segments gives the share that has no clause structure: neither
a predicate with its particles (Japanese), function words (English, Chinese),
nor the form of an entry that belongs to a text, such as a reference, a
contents line, a heading, a labelled value or a question. Clauses stuffed with
a recurring substring are no structure either: text in form only. A linear
score of both, learned from generated pages, decides.

The automaton is built for every page, of whatever length, for many pages at
once. Its states are the nodes of the suffix tree of the reversed page, whose
edges are the suffix links: sorting all reversed prefixes by doubling, and the
common prefixes of neighbours in that order, give every state that occurs
three times with its longest string and its end positions. Clauses are held
against all of them; coverage and density read those that are often.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A clause is stuffed that says a keyword this often and consists of it to this share.
TIMES, SHARE = 3, 0.3
#: Labelled pages generated for training.
PAGES = 1200
_SLOTS = 1 << 20
#: Occurrences of strings that are held against clauses at once.
_TOGETHER = 1 << 19


class States(NamedTuple):
    """States of the suffix automata of many pages that occur ``TIMES`` or more, from short to long: page, length of the longest string, and end positions.

    The ends of state ``k`` are ``ends[left[k]:right[k] + 1]``, places in the
    joined text right after an occurrence. A state's ends are among those of
    its suffix link, so the runs are nested.
    """

    page: np.ndarray
    length: np.ndarray
    left: np.ndarray
    right: np.ndarray
    ends: np.ndarray


class Joined(NamedTuple):
    """Code points of many pages, each followed by a zero, and where each page begins and ends."""

    codes: np.ndarray
    start: np.ndarray
    stop: np.ndarray


def join(texts: list[str]) -> Joined:
    """Many pages as one array of code points; zeros in them become blanks."""
    joined = "\0".join([*(x.replace("\0", " ") for x in texts), ""])
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    stop = np.flatnonzero(codes == 0)
    return Joined(codes, np.concatenate([[0], stop[:-1] + 1]), stop)


def often(size: np.ndarray, per: int) -> np.ndarray:
    """How often a string must occur in a page of so many characters to count for its coverage."""
    return np.maximum(TIMES, size // per)


def states(j: Joined, shortest: int = 2) -> States:
    """Every state of length ``shortest`` or more that occurs ``TIMES`` or more, however long the page.

    Places are ranked by the strings that begin there, of length 3, 6, 12 and
    so on, and refined only while so many of a page share a rank: the work
    follows what recurs. The ranks of all lengths then give the common length
    of two neighbours in the order, exactly as far as it recurs so often.
    """
    n = len(j.codes)
    size = j.stop - j.start
    page = np.repeat(np.arange(len(size)), size + 1)
    # reversed, what begins here ends there; a zero also stands before the first page
    back, owner = (np.concatenate([x[::-1], [end]]) for x, end in ((j.codes, 0), (page, -1)))
    n += 1

    def ahead(x: np.ndarray, by: int, fill: int) -> np.ndarray:
        return np.concatenate([x[by:], np.full(min(by, len(x)), fill, dtype=x.dtype)])

    # two characters that recur too seldom begin nothing that recurs often; hashes that meet only let more through
    one = ahead(back, 1, 0)
    slot = ((back << 21 | one) * 0x9E3779B1 + owner * 0x85EBCA77 & 0x7FFFFFFF) % _SLOTS
    sa = np.flatnonzero((back != 0) & (one != 0) & (np.bincount(slot, minlength=_SLOTS)[slot] >= TIMES))
    there = np.bincount(back) > 0
    kinds = np.flatnonzero(there)
    bits = len(kinds).bit_length()
    kind = (np.cumsum(there) - 1)[back]
    small = kind[sa] << 2 * bits | ahead(kind, 1, 0)[sa] << bits | ahead(kind, 2, 0)[sa]
    if 3 * bits + len(size).bit_length() < 63:
        key = owner[sa] << 3 * bits | small
        turn = np.argsort(key)
    else:
        key = np.unique(np.stack([owner[sa], small]), axis=1, return_inverse=True)[1].reshape(-1)
        turn = np.argsort(key)
    sa, key = sa[turn], key[turn]
    new = np.ones(len(sa), dtype=bool)
    new[1:] = key[1:] != key[:-1]
    group = np.cumsum(new) - 1
    rank = np.full(n, -1, dtype=np.int64)
    rank[sa] = np.flatnonzero(new)[group]
    live = np.zeros(n, dtype=bool)
    live[sa] = (np.bincount(group)[group] if len(sa) else group) >= TIMES
    levels, width = [], 3
    while live.any():
        levels.append((width, np.where(live, rank, -1)))
        own = np.flatnonzero(live)
        far = np.minimum(own + width, n - 1)
        same = (own + width < n) & (owner[far] == owner[own])
        # the character first: places left out above have no rank
        key = np.where(same, kind[far], 0) * (n + 1) + np.where(same, rank[far], -1) + 1
        wide = len(kinds) * (n + 1)
        turn = np.argsort(rank[own] * wide + key) if n * wide < 1 << 62 else np.lexsort((key, rank[own]))
        own, key, same, far = own[turn], key[turn], same[turn], far[turn]
        old = rank[own]
        new = np.ones(len(own), dtype=bool)
        new[1:] = (old[1:] != old[:-1]) | (key[1:] != key[:-1])
        first = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        begun = np.maximum.accumulate(np.where(np.concatenate([[True], old[1:] != old[:-1]]), np.arange(len(old)), 0))  # where the former group begins
        still = same & live[far] & (np.bincount(group)[group] >= TIMES)
        sa[old + np.arange(len(own)) - begun] = own
        rank[own] = old + first[group] - begun
        live[:] = False
        live[own] = still
        width *= 2
    order = sa
    a, b = order[:-1].copy(), order[1:].copy()
    same = owner[a] == owner[b]
    lcp = np.zeros(len(a), dtype=np.int64)
    for depth, r in reversed(levels):
        ra = r[a]
        hit = same & (ra >= 0) & (ra == r[b])
        lcp[hit] += depth
        a[hit] = np.minimum(a[hit] + depth, n - 1)
        b[hit] = np.minimum(b[hit] + depth, n - 1)
    alive = same
    for _ in range(3):
        alive = alive & (back[a] == back[b]) & (back[a] != 0)
        lcp[alive] += 1
        a[alive] = np.minimum(a[alive] + 1, n - 1)
        b[alive] = np.minimum(b[alive] + 1, n - 1)
    return _states(order, lcp, owner, shortest, n - 1)


def _states(order: np.ndarray, lcp: np.ndarray, owner: np.ndarray, shortest: int, n: int) -> States:
    """The runs of neighbours that share their beginning: one state each, from short strings to long ones."""
    deep = np.concatenate([[0], np.where(lcp >= shortest, lcp, 0), [0]])
    deep[1:-1] = np.minimum(deep[1:-1], np.maximum(deep[:-2], deep[2:]))  # what just two neighbours share is no state
    at = np.flatnonzero(deep[1:] != deep[:-1])
    length, left, right = [], [], []
    open_: list[tuple[int, int]] = []  # length, first place
    top = 0
    for i, x in zip(at.tolist(), deep[at + 1].tolist(), strict=True):
        first = i
        while top > x:
            size, first = open_.pop()
            length.append(size)
            left.append(first)
            right.append(i)
            top = open_[-1][0] if open_ else 0
        if x > top:
            open_.append((x, first))
            top = x
    length, left, right = (np.array(f, dtype=np.int64) for f in (length, left, right))
    turn = np.argsort(length * (n + 1) + left)
    length, left, right = length[turn], left[turn], right[turn]
    return States(owner[order[left]] if len(left) else left, length, left, right, n - order)


class Keywords(NamedTuple):
    """What recurs in each page: coverage, the share of the densest string and that string; and the clauses that are stuffed."""

    coverage: np.ndarray
    density: np.ndarray
    densest: list[str]
    stuffed: np.ndarray


def keywords(texts: list[str], clauses: tuple[np.ndarray, np.ndarray] | None = None, shortest: int = 2, per: int = 100) -> Keywords:
    """The recurring maximal substrings of pages, from their automata.

    Strings of Latin letters, digits and signs count from four characters.
    Coverage and density are by those that occur once in ``per`` characters, as
    any two letters recur in a long page. ``clauses`` are begins and ends in the
    joined pages, in order. Every recurring substring is held against every
    clause that holds it, however seldom it is for the page's length.
    """
    j = join(texts)
    text = "\0".join(x.replace("\0", " ") for x in texts) + "\0"
    s = states(j, shortest)
    n = len(j.codes)
    page = np.repeat(np.arange(len(texts)), j.stop - j.start + 1)
    blank, bound, sign = (_marks(j.codes, form) for form in (r"[\s\0]", r"[ぁ-んー、。\s]", r"[\W\d_]"))
    total = np.maximum(1, np.bincount(page, weights=~blank, minlength=len(texts)))
    # the string of each state without blanks at its ends, and whether it is more than inflections and signs
    at = np.arange(n)
    after = np.minimum.accumulate(np.where(blank, n, at)[::-1])[::-1]  # the next that is no blank
    before = np.maximum.accumulate(np.where(blank, -1, at))
    end = s.ends[s.left] if len(s.left) else s.left
    begin = end - s.length
    lead = np.minimum(after[begin] - begin, s.length)
    trail = np.minimum(end - 1 - before[end - 1], s.length)
    bare = s.length - lead - trail

    def among(marks: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(marks)])
        return sums[np.maximum(end - trail, begin + lead)] - sums[begin + lead]

    ok = (bare >= shortest) & ((bare >= 4) | (among(j.codes > 127) > 0)) & (among(~bound) > 0) & (among(~sign) > 0)
    tried = np.flatnonzero(ok)
    own = tried[(s.right - s.left + 1)[tried] >= often(j.stop - j.start, per)[s.page[tried]]]
    # coverage: the longest state at each end
    best = np.zeros(n + 1, dtype=np.int64)
    _paint(best, s, own)
    ends = np.flatnonzero(best)
    covered = np.bincount(ends - best[ends], minlength=n + 1) - np.bincount(ends, minlength=n + 1)
    stuffed = _stuffed(s, tried, bare, trail, clauses, page) if clauses else np.zeros(0, dtype=bool)
    inside = (np.cumsum(covered)[:n] > 0) & ~blank
    # the densest string of each page
    share = np.minimum(1.0, (s.right - s.left + 1)[own] * bare[own] / total[s.page[own]])
    first = np.lexsort((bare[own], -share, s.page[own]))
    lead_of = first[np.concatenate([[True], s.page[own][first][1:] != s.page[own][first][:-1]])] if len(first) else first
    density, densest = np.zeros(len(texts)), [""] * len(texts)
    for k in lead_of.tolist():
        i = own[k]
        density[s.page[i]], densest[s.page[i]] = share[k], text[begin[i] + lead[i] : end[i] - trail[i]]
    return Keywords(np.bincount(page, weights=inside, minlength=len(texts)) / total, density, densest, stuffed)


@lru_cache(maxsize=8)
def _table(form: str) -> np.ndarray:
    """Which characters of the basic plane have a form."""
    match = re.compile(form).fullmatch
    return np.array([match(chr(c)) is not None for c in range(0x10000)])


def _marks(codes: np.ndarray, form: str) -> np.ndarray:
    """Which code points have a form."""
    out = _table(form)[np.minimum(codes, 0xFFFF)]
    for c in np.unique(codes[codes > 0xFFFF]).tolist():
        out[codes == c] = re.fullmatch(form, chr(c)) is not None
    return out


def _paint(best: np.ndarray, s: States, own: np.ndarray) -> None:
    """Set the length of the longest of the states at each of their ends, run by run: runs are nested."""
    order = own[np.lexsort((s.length[own], -s.right[own], s.left[own]))]
    open_: list[tuple[int, int]] = []  # right end, length
    at = 0

    def fill(upto: int) -> None:
        nonlocal at
        while open_ and at < upto:
            right, length = open_[-1]
            to = min(right + 1, upto)
            if to > at:
                best[s.ends[at:to]] = length
                at = to
            if right + 1 <= upto:
                open_.pop()
        at = max(at, upto)

    for left, right, length in zip(s.left[order].tolist(), s.right[order].tolist(), s.length[order].tolist(), strict=True):
        fill(left)
        open_.append((right, length))
    fill(len(s.ends))


def _stuffed(s: States, own: np.ndarray, bare: np.ndarray, trail: np.ndarray, clauses: tuple[np.ndarray, np.ndarray], page: np.ndarray) -> np.ndarray:
    """Which clauses say one of the states' strings ``TIMES`` or more and consist of it to ``SHARE`` or more.

    From short strings to long ones, many at once: a page is left when its
    clauses that aren't stuffed yet are too short for the string.
    """
    begins, stops = clauses
    out = np.zeros(len(begins), dtype=bool)
    if not len(begins):
        return out
    size = stops - begins
    of = page[begins]
    clause = np.full(len(page) + 1, -1)  # the clause at each place
    clause[begins] = np.arange(len(begins))
    clause = np.maximum.accumulate(clause)
    while len(own):
        longest = np.zeros(int(page[-1]) + 1, dtype=np.int64)
        np.maximum.at(longest, of[~out], size[~out])
        own = own[bare[own] * TIMES <= longest[s.page[own]]]
        upto = max(1, int(np.searchsorted(np.cumsum(s.right[own] - s.left[own] + 1), _TOGETHER)))
        some, own = own[:upto], own[upto:]
        n = s.right[some] - s.left[some] + 1
        k = np.repeat(np.arange(len(some)), n)  # one row per occurrence
        last = s.ends[np.arange(len(k)) + np.repeat(s.left[some] - np.concatenate([[0], np.cumsum(n)[:-1]]), n)] - trail[some][k]
        wide = bare[some][k]
        begin = last - wide
        c = clause[begin]
        fit = (c >= 0) & (last <= stops[c]) & ~out[c] & (wide * TIMES <= size[c]) & (n[k] * wide >= SHARE * size[c])
        k, begin, c = k[fit], begin[fit], c[fit]
        turn = np.argsort(k * len(page) + begin)
        k, begin, c = k[turn], begin[turn], c[turn]
        new = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (c[1:] != c[:-1])])) if len(k) else k
        times = np.diff(np.concatenate([new, [len(k)]]))
        wide, which = bare[some][k[new]], c[new]
        hit = (times >= TIMES) & (times * wide >= SHARE * size[which])
        new, times, wide, which = new[hit], times[hit], wide[hit], which[hit]
        over = np.concatenate([(begin[1:] - begin[:-1] < bare[some][k[1:]]) & (k[1:] == k[:-1]), [False]]) if len(k) else k
        over = np.concatenate([[0], np.cumsum(over)])
        over = over[new + np.maximum(times - 1, 0)] > over[new]
        out[which[~over]] = True
        for i in np.flatnonzero(over).tolist():  # overlapping: one after the other, as they are read
            if out[which[i]]:
                continue
            count, at, w = 0, -1, int(wide[i])
            for x in begin[new[i] : new[i] + times[i]].tolist():
                if x >= at:
                    count, at = count + 1, x + w
            out[which[i]] = count >= TIMES and count * w >= SHARE * size[which[i]]
    return out


#: Inflections and joints recur in any text and are no keywords: Japanese syllables alone, and signs and digits alone.
_FILLER = re.compile(r"[ぁ-んー、。\s]+|[\W\d_]+")
_LINE = re.compile(r"[^\r\n]+")
_SENTENCE = re.compile(r"[^。！？!?]+[。！？!?]*|[。！？!?]+")
_JA_PREDICATE = re.compile(r"(?:[うくすつぬむるいただ]|です|ます|でした|ました|せん|ください|せよ|べよ|こと|ため|もの|とき|ない)[。．.！？!?」』）)]*$")
# Particles and function words that mark clause structure.
_JA_PARTICLE = re.compile(r"[はがをにへもでとの]|から|より|まで")
_EN_FUNCTION = {"the", "of", "is", "was", "were", "are", "to", "in", "that", "with", "for", "by", "and", "can", "be", "we", "when", "after", "from", "on", "at", "its", "it", "this", "how", "then", "as", "should", "has", "have", "not", "no", "a", "an", "or", "so", "what", "why", "does"}
_ZH_FUNCTION = re.compile("[的了在是会應应与將将为為被从從對对不可中其该該这這有和着於于至若則则当當时時没之必须先后也都而但]")
_KANA = re.compile(r"[ぁ-んァ-ヴ]")
_HIRAGANA = re.compile(r"[ぁ-ん]")
_WORD = re.compile(r"[A-Za-z][A-Za-z'-]*")
_TERM = re.compile(r"[ァ-ヴー]{2,}|[一-龠々]{2,}|[A-Za-z]{3,}")
_URL = re.compile(r"https?://\S+|www\.\S+")
_SHORT = "https://"
#: Entries that belong to a text without being clauses: contents, references, headings, labelled values, numbers, questions and answers.
_ENTRY = re.compile(
    r"""\s*(?:
      .*(?:\.{3,}|…+|・{3,})\s*\d+\s*$                       # a contents line
    | \[\d+\]\s*\S.{8,}                                      # a reference
    | .*\d{4}\s*年.*(?:頁|ページ|巻|号).*                      # a reference without its number
    | 第\s*\d+\s*[章節条項部編].{0,40}$                        # a heading
    | \d+(?:\.\d+)*[.)]?\s+\S.{0,40}$                         # a numbered heading
    | \#{1,6}\s+\S.{0,60}$                                    # a marked heading
    | [-*・]?\s*\**[^:：|>#]{1,24}\**[:：]\s*[-+±約]?\s*\d[\d.,]*\s*\S{0,8}\s*$   # a labelled value
    | [-*]\s+\*\*[^*]{1,24}\*\*\s*[:：].*                     # a labelled entry
    | (?:質問|回答|問|答|Q|A)\s*[:：].*                        # a question or an answer
    | [-+−]?\d[\d.,]*\s*\S{0,8}\s*$                           # a value
    )""",
    re.VERBOSE,
)
_LABEL = re.compile(r"\s*(?:[^\s:：|>#]{1,24}[:：])\s*$")
_PRICE = re.compile(r"\d[\d,]*\s*円|[¥￥$]\s*\d|★|☆|カート|残り\s*\d+\s*点")
#: One of these stands in every price.
_PRICED = ("円", "¥", "￥", "$", "★", "☆", "カート", "残り")
_CHAIN = re.compile(r"[#＃>＞|｜→»]|^\[.*\]$|\[\d+\]|\(\d+\)|\[[^\]]+\]\(|、\S{1,12}、")


def _linked(s: str) -> bool:
    """Whether a text may hold an address."""
    return "://" in s or "www." in s


def _has_clause(s: str) -> bool:
    """Whether a sentence-like stretch has clause structure in one of the languages."""
    body = (_URL.sub("", s) if _linked(s) else s).strip()
    if len(body) < 6:
        return False
    if _KANA.search(body):
        if len(_HIRAGANA.findall(body)) < 3 or len(_JA_PARTICLE.findall(body)) < 2:
            return False
        if _JA_PREDICATE.search(body):
            return True
        terms = _TERM.findall(body)  # a sentence that ends in a noun, unless it is one word over and over
        return body[-1] in "。．" and len(_HIRAGANA.findall(body)) >= 4 and max(map(terms.count, terms), default=0) <= 2
    words = _WORD.findall(body)
    if len(words) >= 4:
        known = sum(w.lower() in _EN_FUNCTION for w in words)
        if known >= 2 and known * 8 >= len(words):
            return True
    return len(_ZH_FUNCTION.findall(body)) >= 2 and len(body) >= 8 and len(words) * 3 < len(body)


class Line(NamedTuple):
    """A line's characters by kind: in clauses, by their number in the page, and in items; or all in an entry of a text, or alone."""

    size: int
    kind: str  # "entry", "lone" (a short line that says nothing) or "parts"
    bullet: bool
    clauses: list[tuple[int, int]]  # begin and end in the page
    item: int


def parse(text: str) -> list[Line]:
    """The page's lines, taken apart into clauses and items."""
    out = []
    linked, priced_at_all = _linked(text), any(x in text for x in _PRICED)
    for m in _LINE.finditer(text):
        line = m[0]
        bare = line.strip()
        if not bare:
            continue
        at = m.start() + len(line) - len(line.lstrip())
        urls = linked and _URL.search(bare)
        priced = priced_at_all and _PRICE.search(bare)
        if not urls and not priced and _ENTRY.match(bare):
            out.append(Line(len(bare), "entry", False, [], 0))
            continue
        lone, item = False, 0
        clauses: list[tuple[int, int]] = []
        for part in _SENTENCE.finditer(bare):
            whole = part[0]
            s = whole.strip()
            if not s:
                continue
            begin = at + part.start() + len(whole) - len(whole.lstrip())
            for p, offset in _english_sentences(s) if "." in s else [(s, 0)]:
                if _has_clause(p):
                    clauses.append((begin + offset, begin + offset + len(p)))
                elif not urls and not priced and len(bare) <= 40 and p == bare and not _CHAIN.search(p) and p.count(" ") <= 2:
                    lone = True
                else:
                    item += len(_URL.sub(_SHORT, p)) if urls else len(p)  # an address counts as a short word
        out.append(Line(len(bare), "lone" if lone else "parts", bare[0] in "・-*•●○", clauses, item))
    return out


#: Where an English sentence ends, be it followed by a blank or, if it has clause structure, not.
_ENGLISH_END = re.compile(r"(?<=[a-z0-9%)]\.)\s+(?=[A-Z])|(?<=[a-z]{2}\.)(?=[A-Z][a-z]* )")


def _english_sentences(s: str) -> list[tuple[str, int]]:
    """English sentences of a stretch with their offsets."""
    out, at = [], 0
    for m in _ENGLISH_END.finditer(s):
        if not m[0] and not _has_clause(s[at : m.start()]):
            continue
        out.append((s[at : m.start()], at))
        at = m.end()
    return [*out, (s[at:], at)]


class Shape(NamedTuple):
    """Characters of a page by kind."""

    clause: int
    entry: int
    item: int
    stuffed: int


def shape(lines: list[Line], stuffed: Iterator[bool] | None = None) -> Shape:
    """Characters in clauses, in entries that belong to a text, in items (keywords, links, tags, products) and in stuffed clauses.

    ``stuffed`` says of each clause in order whether it is; without it none is.
    """
    clause = entry = item = full = 0
    alone = 0  # sizes of short lines in a row that neither begin with a mark nor say anything
    count = 0
    listed = False  # whether the line before them was made of items

    def settle(followed: bool) -> None:
        nonlocal entry, item, alone, count
        # up to five short lines in a row are headings or captions; among items, or more, they are a list of names
        if listed or followed or count > 5:
            item += alone
        else:
            entry += alone
        alone = count = 0

    for line in lines:
        if line.kind == "entry":
            settle(False)
            entry, listed = entry + line.size, False
            continue
        if line.kind == "lone" and not line.bullet:
            alone, count = alone + line.size, count + 1
            continue
        said, made = 0, line.item
        for b, e in line.clauses:
            if stuffed is not None and next(stuffed):
                made += e - b
                full += e - b
            else:
                said += e - b
        clause, item = clause + said, item + line.item
        followed = made > said
        settle(followed)
        listed = followed
        if line.kind == "lone":
            entry += line.size
    settle(False)
    return Shape(clause, entry, item, full)


class Page(NamedTuple):
    """The measures of a page and its score."""

    score: float
    missing: float
    coverage: float
    density: float
    keyword: str


#: What the score reads: one, the share without clause structure, the share of stuffed clauses in that, coverage, density, and the first with coverage.
READS = ("one", "missing", "stuffed", "coverage", "density", "missing_covered")


def _reads(missing: np.ndarray, stuffed: np.ndarray, coverage: np.ndarray, density: np.ndarray) -> np.ndarray:
    return np.stack([np.ones(len(missing)), missing, stuffed, coverage, density, missing * coverage], axis=1)


def measures(texts: list[str]) -> tuple[np.ndarray, list[str]]:
    """What the score reads of each page, and its densest recurring string."""
    lines = [parse(x) for x in texts]
    start = np.concatenate([[0], np.cumsum([len(x) + 1 for x in texts])]).astype(np.int64)
    spans = [(start[i] + b, start[i] + e) for i, own in enumerate(lines) for line in own for b, e in line.clauses]
    clauses = (np.array([b for b, _ in spans], dtype=np.int64), np.array([e for _, e in spans], dtype=np.int64))
    k = keywords(texts, clauses)
    flags = iter(k.stuffed.tolist())
    shapes = [shape(own, flags) for own in lines]
    total = np.array([max(1, s.clause + s.entry + s.item + s.stuffed) for s in shapes])
    stuffed = np.array([s.stuffed for s in shapes]) / total
    missing = np.array([s.item for s in shapes]) / total + stuffed
    return _reads(missing, stuffed, k.coverage, k.density), k.densest


# --- labelled pages and the score -----------------------------------------


def _block(rng: random.Random, spam: bool, topic: str) -> str:
    """A stretch of running text or of what belongs to one; or of keywords, links, tags, products or stuffed sentences."""
    things = ["ポンプ", "軸受", "主軸", "歯車", "センサ", "弁", "継手", "送風機", "配管", "電源"]
    n = lambda a=1, b=99: rng.randint(a, b)
    t = lambda: rng.choice(things)
    if not spam:
        prose = [lambda: f"{t()}の温度が{n()}度まで上昇したため、{t()}を停止して点検を行った。", lambda: f"{topic}の寿命は荷重によって変わり、{t()}との組み合わせにも左右される。", lambda: f"図{n()}に示すように、{t()}の回転数は時間とともに低下した。", lambda: f"The {rng.choice(['pump', 'valve', 'motor'])} was opened slowly and the pressure was measured at the outlet after {n()} minutes.", lambda: f"{topic}を選ぶときは、使用する温度と荷重を確かめる必要がある。", lambda: f"试验表明,在{n()}度的条件下轴承的寿命是稳定的,但是压力会下降。"]
        other = [lambda: f"[{n()}] {topic}における摩耗の解析、機械集報、20{n(10, 24)}年、第{n()}巻、{n()}ページ。", lambda: f"第{n()}章 {topic}の概要 ...... {n()}", lambda: f"消費電力{n()}: {n()}.5 kW", lambda: f"- **{t()}**: {topic}を支える部品のこと。", lambda: f"{n()}.{n()} {topic}の構成", lambda: f"質問: {topic}はどのように選びますか。"]
        kind = rng.random()
        if kind < 0.65:
            return "".join(rng.choice(prose)() for _ in range(n(2, 6)))
        if kind < 0.72:  # about one thing
            about = [f"この{topic}は小型{topic}とも呼ばれる。", f"{topic}の交換には専用の工具を使う。", f"購入した{topic}は、{topic}の箱に入れて保管する。", f"{topic}が故障すると{t()}も止まる。", f"価格は{topic}の大きさで決まり、{n()}個から割引となる。", f"{topic}の温度を{n()}分ごとに記録した。"]
            return "".join(rng.choice(about) for _ in range(n(4, 12)))
        if kind < 0.78:  # said again, as boilerplate is
            return rng.choice(prose)() * n(3, 9)
        make = rng.choice(other)
        return "\n".join(make() for _ in range(n(2, 8)))
    words = [topic, topic, "激安", "通販", "最安値", "送料無料", "人気", "ランキング", t(), "比較", "口コミ"]
    english = ["best", "cheap", "buy", "online", "pump", "sale", "price", "discount", "shop"]
    kinds = [
        lambda: " ".join(rng.choice(words) for _ in range(n(20, 90))), lambda: " ".join("#" + rng.choice(words) + rng.choice(["", t()]) for _ in range(n(8, 40))), lambda: "\n".join(f"- {rng.choice(words)}{n()} https://{rng.choice('abc')}.example/{n()}" for _ in range(n(4, 20))),
        lambda: " > ".join(["ホーム", rng.choice(words), t(), topic]) + "\n" + " | ".join(rng.choice(words) + str(n()) for _ in range(n(6, 20))), lambda: "\n".join(f"{topic}-{n()} | {t()} | {n(100, 99999)}円 | 在庫あり" for _ in range(n(4, 20))), lambda: " ".join(rng.choice(english) for _ in range(n(20, 80))),
        lambda: "".join(f"{topic}は{topic}、{rng.choice(words)}の{topic}なら{topic}の{t()}が{topic}に強い。" for _ in range(n(3, 9))), lambda: f"Buy {rng.choice(english)} pump from the pump shop, the pump that is the best pump. " * n(3, 9), lambda: "\n".join(f"[{t()}{n()}](/item/{n()})" for _ in range(n(5, 20))), lambda: "、".join(rng.choice(words) + t() for _ in range(n(15, 60))),
    ]
    return rng.choice(kinds)()


@lru_cache(maxsize=1)
def model(pages: int = PAGES, seed: int = 17) -> tuple[float, ...]:
    """Weights of the score, by logistic regression on generated pages: a case is one of which more than half is spam."""
    rng = random.Random(seed)
    texts, label = [], []
    for _ in range(pages):
        topic = rng.choice(["ポンプ", "軸受", "主軸", "送風機", "compressor", "減速機", "バルブ"])
        share = rng.choice([0.0, 0.0, 0.3, 0.4, 0.6, 0.7, 1.0, 1.0])
        blocks, size = [], [0, 0]
        for _ in range(rng.randint(1, 6)):
            spam = rng.random() < share
            blocks.append(_block(rng, spam, topic))
            size[spam] += len(blocks[-1])
        texts.append(rng.choice(["\n", "\n\n"]).join(blocks))
        label.append(size[1] > size[0])
    x = np.concatenate([measures(texts[i : i + 200])[0] for i in range(0, len(texts), 200)])
    y = np.array(label, dtype=float)
    w = np.zeros(len(READS))
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (p - y) / len(y) + 1e-3 * w
        h = (x * (p * (1 - p))[:, None]).T @ x / len(y) + 1e-3 * np.eye(len(w))
        w -= np.clip(np.linalg.solve(h, g), -3, 3)
    return tuple(w.tolist())


def measure(texts: list[str], weights: tuple[float, ...] | None = None) -> list[Page]:
    """The measures of each page; ``score`` is the probability of a case, 0 for blank pages."""
    x, densest = measures(texts)
    score = 1 / (1 + np.exp(-np.clip(x @ np.array(weights or model()), -30, 30)))
    return [Page(float(s) if text.strip() else 0.0, float(r[1]), float(r[3]), float(r[4]), k) for text, s, r, k in zip(texts, score, x, densest, strict=True)]


def pages(df: DataFrame, key: str = "doc_id", text: str = "text", most: int = 300_000) -> DataFrame:
    """``(key, score, missing, coverage, density, keyword, stuffed)`` of every row; null and blank text score 0.

    Pages are measured whole, and together up to about ``most`` characters.
    """
    kind = dict(df.dtypes)[key]
    weights = model()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            keys, texts = list(b["k"]), [x or "" for x in b["x"]]
            at = 0
            while at < len(texts):
                to, size = at, 0
                while to < len(texts) and size < most:
                    size += len(texts[to])
                    to += 1
                out = pd.DataFrame(measure(texts[at:to], weights), columns=["score", "missing", "coverage", "density", "keyword"])
                out.insert(0, "k", pd.Series(keys[at:to], dtype=b["k"].dtype))
                yield out.assign(stuffed=out["score"] > 0.5)
                at = to

    done = df.select(F.col(key).alias("k"), F.col(text).alias("x")).mapInPandas(run, f"k {kind}, score double, missing double, coverage double, density double, keyword string, stuffed boolean")
    return done.withColumnRenamed("k", key)

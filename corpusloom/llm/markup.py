"""Markup residue: which languages of markup a text still carries, and its clean form.

A text is a tree: the page, its blocks (runs of lines without a blank one) and
in each block the constructs that may be markup. Every node has a label, plain
text or one of four languages; potentials tie a child's label to its parent's
and a construct's form to its label. Ambiguous forms, such as a starred list
entry or a pair of dollars, are thus decided by what stands around them. Sum-
product messages go up from the constructs to the page and down again, for all
texts of a batch at once, and give each construct the probability of being
content or markup of each language.

The potentials are counted on labelled pages, which are generated from small
grammars of the four languages and of plain prose with its own signs: prices,
paths, formulas, comparisons, reference numbers, code names.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LABELS = ("text", "html", "markdown", "wiki", "latex")
#: Labelled pages generated for training.
PAGES = 1500
PAGE_MARK = re.compile(r"<!-- Page \d+ -->")

# Names of HTML elements, and of elements that belong to wiki text.
_HTML = "a abbr address article aside b big blockquote body br button caption center cite code col colgroup dd del details div dl dt em embed fieldset figcaption figure font footer form h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd label legend li link main map mark meta nav noscript object ol option p param pre q rp rt ruby s samp script section select small source span strike strong style sub summary sup svg table tbody td textarea tfoot th thead time title tr tt u ul var video".split()
_WIKI = "ref references nowiki gallery noinclude includeonly onlyinclude math syntaxhighlight".split()
_TAG = re.compile(r"</?([A-Za-z][A-Za-z0-9]*)(?:\s[^<>]*)?/?>")
# By first character: what a construct may look like from there on, with the name of its form; the first that fits is taken.
_FORMS: dict[str, list[tuple[str, re.Pattern]]] = {
    "<": [("comment", re.compile(r"<!--.*?-->", re.S)), ("doctype", re.compile(r"<!DOCTYPE[^>]*>", re.I)), ("tag", _TAG), ("angle", re.compile(r"<"))],
    "&": [("entity", re.compile(r"&(?:[A-Za-z]{2,8}[0-9]{0,2}|#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6});")), ("row_end", re.compile(r"&[^&\n]*\\\\")), ("amp", re.compile(r"&"))],
    "*": [("star_strong", re.compile(r"\*{2,3}(?=\S)[^*\n]+?(?<=\S)\*{2,3}")), ("star_em", re.compile(r"\*(?=[^\s*])[^*\n]+?(?<=[^\s*])\*")), ("star", re.compile(r"\*+"))],
    "_": [("low_strong", re.compile(r"(?<![A-Za-z0-9_])__(?=\S)[^_\n]+?(?<=\S)__")), ("magic", re.compile(r"__[A-Z]{3,}__")), ("low", re.compile(r"_+"))],
    "~": [("strike", re.compile(r"~~(?=\S)[^~\n]+?(?<=\S)~~")), ("tie", re.compile(r"~(?=\\)")), ("tilde", re.compile(r"~+"))],
    "`": [("code", re.compile(r"(`+)[^`\n]+\1")), ("tick", re.compile(r"`+"))],
    "!": [("image", re.compile(r"!\[[^\]\n]*\]\([^)\n]*\)")), ("bang", re.compile(r"!"))],
    "[": [
        ("file_link", re.compile(r"\[\[(?:ファイル|File|Image|画像|Category|カテゴリ):[^\[\]\n]+\]\]", re.I)), ("wiki_link", re.compile(r"\[\[[^\[\]\n]+\]\]")), ("wiki_url", re.compile(r"\[(?:https?|ftp)://[^\s\]]+ [^\]\n]+\]")),
        ("footnote", re.compile(r"\[\^[^\]\s]+\]:?")), ("link", re.compile(r"\[[^\[\]\n]+\]\((?:https?://|#|/|\.|mailto:|[\w-]+[./])[^)\s]*(?:\s\"[^\"\n]*\")?\)")), ("ref_link", re.compile(r"\[[^\[\]\n]+\]\[[^\[\]\n]*\]")), ("number", re.compile(r"\[\d{1,4}\]")), ("bracket", re.compile(r"\[")),
    ],
    "{": [("table_open", re.compile(r"\{\|")), ("template", re.compile(r"\{\{[^{}\n]+\}\}")), ("template_open", re.compile(r"\{\{[^{}\n|]+$", re.M)), ("brace", re.compile(r"\{+"))],
    "}": [("template_close", re.compile(r"\}\}")), ("brace_close", re.compile(r"\}+"))],
    "'": [("quote_strong", re.compile(r"'{3,5}[^'\n]+'{3,5}")), ("quote_em", re.compile(r"''[^'\n]+''")), ("quote", re.compile(r"'+"))],
    "\\": [
        ("environment", re.compile(r"\\(?:begin|end)\{[A-Za-z]+\*?\}")), ("command", re.compile(r"(?<![A-Za-z0-9:])\\[A-Za-z]+\*?(?:\[[^\]\n]*\])?\{")), ("display", re.compile(r"\\[\[\]()]")), ("row_break", re.compile(r"\\\\(?=\s|$)", re.M)),
        ("word", re.compile(r"(?<![A-Za-z0-9:\\])\\[A-Za-z]+(?![A-Za-z\\])")), ("path", re.compile(r"\\[A-Za-z0-9]*")),
    ],
    "$": [("dollars", re.compile(r"\$\$")), ("math", re.compile(r"\$(?=[^\s$])[^$\n\\^_{}=]*[\\^_{}=][^$\n]*(?<=\S)\$")), ("math_name", re.compile(r"\$[A-Za-z](?:['′]|_[A-Za-z0-9])?\$")), ("price", re.compile(r"\$\s?\d")), ("dollar", re.compile(r"\$"))],
    "^": [("caret", re.compile(r"\^"))],
    "|": [("bars", re.compile(r"\|\|")), ("bar", re.compile(r"\|"))],
}
# What a line may look like as a whole; the first that fits is taken.
_LINES = [
    ("redirect", re.compile(r"#(?:転送|REDIRECT)\b.*", re.I)), ("hash_link", re.compile(r"#{1,4}[ \t]*\[\[.*")), ("heading", re.compile(r"#{1,6}[ \t]+\S.*")), ("hash_number", re.compile(r"#\d.*")), ("fence", re.compile(r"(?:`{3,}|~{3,})[\w+-]*\s*$")),
    ("equals_heading", re.compile(r"(={2,6})[^=\n].*?\1\s*$")), ("underline", re.compile(r"(?:={3,}|-{3,})\s*$")), ("rule_row", re.compile(r"\|?\s*:?-{3,}:?\s*(?:\|\s*:?-{3,}:?\s*)+\|?\s*$")), ("table_row", re.compile(r"\|[^|\n-].*\|.*\|\s*$")),
    ("row_mark", re.compile(r"\|-+\s*$")), ("table_close", re.compile(r"\|\}\s*$")), ("cells", re.compile(r"[|!][^|\n]*(?:\|\||!!).*")), ("parameter", re.compile(r"\|\s*[^|=\n]+=.*")), ("quote_line", re.compile(r">+[ \t]\S.*")), ("stars", re.compile(r"\*{1,4}[ \t]*[^*\s].*")),
    ("dash", re.compile(r"[ \t]*[-+][ \t]+\S.*")), ("semicolon", re.compile(r"[;:]+[ \t]*\S.*")), ("percent", re.compile(r"%[ \t]*\S.*")),
]
_SPECIAL = re.compile(r"[<&*_~`!\[{}'\\$^|]")
_NEEDS = r"[<&*_~`\[{}\\$^|#=%>]|''|(?m)^[ \t]*[-+;:!]|(?m)^-{3,}"
FORMS = sorted({n for fs in _FORMS.values() for n, _ in fs} | {n for n, _ in _LINES} | {"tag_known", "tag_wiki", "tag_known_end", "underline_after"})
_FORM = {n: i for i, n in enumerate(FORMS)}


class Construct(NamedTuple):
    """A stretch that may be markup, with its form and block."""

    start: int
    end: int
    form: int
    block: int


def constructs(text: str) -> tuple[list[Construct], int]:
    """All constructs of a text and the number of its blocks; the format's page marks are none."""
    out: list[Construct] = []
    marks = {(m.start(), m.end()) for m in PAGE_MARK.finditer(text)} if "<!--" in text else set()
    block, at, before = 0, 0, ""
    for line in text.split("\n"):
        bare = line.strip()
        if not bare:
            block += bool(before)
            before = ""
            at += len(line) + 1
            continue
        skip = at
        lead = len(line) - len(line.lstrip())
        for name, form in _LINES:
            if form.match(bare):
                if name == "underline" and before and not re.match(r"[=#|*>-]", before):
                    name = "underline_after"
                out.append(Construct(at + lead, at + len(line), _FORM[name], block))
                break
        for m in _SPECIAL.finditer(line):
            i = at + m.start()
            if i < skip:
                continue
            for name, form in _FORMS[m[0]]:
                hit = form.match(text, i)
                if hit:
                    skip = hit.end()
                    if (i, skip) in marks:
                        break
                    if name == "tag":
                        known = hit[1].lower()
                        name = "tag_known_end" if known in _HTML and text[i + 1] == "/" else "tag_known" if known in _HTML else "tag_wiki" if known in _WIKI else "tag"
                    out.append(Construct(i, skip, _FORM[name], block))
                    break
        before = bare
        at += len(line) + 1
    return out, block + 1


# --- labelled pages -------------------------------------------------------


def _grammar(rng: random.Random):
    """Functions that write plain prose and blocks of each language, as ``(label, text)`` pieces."""
    nouns = ["装置", "部品", "試料", "回路", "試験", "温度", "圧力", "sensor", "valve", "motor", "記録", "方法", "結果", "表面", "負荷"]
    verbs = ["を調べた。", "を測定した。", "が増加した。", "に注意する。", "を示す。", "is stable.", "was measured.", "と考えられる。", "を比較した。"]

    def noun() -> str:
        return rng.choice(nouns) + rng.choice(["", "", "の" + rng.choice(nouns)])

    def n(a: int = 1, b: int = 99) -> str:
        return str(rng.randint(a, b))

    def sentence() -> str:
        return noun() + rng.choice(["", "と" + noun()]) + rng.choice(verbs)

    def prose(k: int = 3) -> str:
        return "".join(sentence() for _ in range(rng.randint(1, k)))

    def plain() -> str:
        return rng.choice(
            [
                lambda: f"費用は ${n(100, 9999)} から ${n(100, 9999)} になった。", lambda: f"#{n()} 号機を使う。", lambda: f"if a == b の場合は {n()} <= k <= {n()} とする。", lambda: f"条件は {n()} mm < x かつ y > {n()} である。",
                lambda: f"C:\\work\\run{n()}\\log に置く。", lambda: f"係数は {n()} * {n()} * {n()} となる。", lambda: f"入力 -> 処理 -> 出力 の順で |x| が {n()} 以下。", lambda: f"集合 {{ x | x > {n()} }} を使う。", lambda: f"R&D の資料 [{n()}] では f(x) = x^2 + {n()} とした。",
                lambda: f"C# と C++ で書かれ max_value_{n()} と get_item を使う。", lambda: f"文献 [{n()}]、[{n()}] を参照。", lambda: f"It's the operator's choice ({n()}%).", lambda: f"約 ~{n()} 個、{n()}% である!", lambda: f"A & B の比は {n()}:{n()} である。",
                lambda: f"[注意] {sentence()}", lambda: f"{{{n()}, {n()}}} の組。", lambda: f"*{sentence()}", lambda: f"※ a_{n()} は別表。",
            ]
        )()

    def text_block() -> list[tuple[str, str]]:
        kind = rng.random()
        if kind < 0.12:
            return [("text", "\n".join(f"{rng.choice(['・', '- ', '- ', '* ', '+ '])}{noun()}" for _ in range(rng.randint(2, 4))))]
        if kind < 0.2:
            return [("text", rng.choice([f"- {n()} -", f"[{n()}]", f"第{n()}章 {noun()}", f"{n(1, 9)}.{n(1, 9)} {noun()}", "\n" + "-" * rng.randint(3, 20) + "\n", f"; {noun()}", f": {noun()}"]))]
        return [("text", "".join(rng.choice([prose, plain, prose])() for _ in range(rng.randint(1, 4))))]

    def html_block() -> list[tuple[str, str]]:
        tag = rng.choice(["p", "div", "span", "li", "b", "i", "td", "P", "strong", "em", "u", "font", "blockquote"])
        return rng.choice(
            [
                lambda: [("html", f"<{tag}{rng.choice(['', ' class=c' + n(), f' id="s{n()}"'])}>"), ("text", prose()), ("html", f"</{tag}>")],
                lambda: [("text", prose()), ("html", rng.choice(["<br>", "<br />", "<BR/>", "<hr>"])), ("text", prose())],
                lambda: [("text", noun()), ("html", rng.choice(["&nbsp;", "&lt;", "&amp;", "&#60;", "&#x394;", "&alpha;", "&plusmn;"])), ("text", plain())],
                lambda: [("html", "<ul>\n"), *[x for _ in range(3) for x in (("html", "  <li>"), ("text", sentence()), ("html", "</li>\n"))], ("html", "</ul>")],
                lambda: [("html", f"<h{n(1, 6)}>"), ("text", noun()), ("html", f"</h{n(1, 6)}>")],
                lambda: [("html", "<table border='1'><tr><th>"), ("text", noun()), ("html", "</th></tr><tr><td>"), ("text", n()), ("html", "</td></tr></table>")],
                lambda: [("text", noun()), ("html", f'<a href="/p/{n()}">'), ("text", noun()), ("html", "</a>"), ("text", plain())],
                lambda: [("html", f'<img src="i{n()}.png" alt="{noun()}">')], lambda: [("text", "CO"), ("html", "<sub>"), ("text", "2"), ("html", "</sub>"), ("text", sentence())],
                lambda: [("html", "<!-- "), ("html", noun()), ("html", " -->")], lambda: [("html", "<pre><code>"), ("text", f"run({n()});"), ("html", "</code></pre>")],
            ]
        )()

    def markdown_block() -> list[tuple[str, str]]:
        mark = rng.choice("-*+")
        fence = rng.choice(["```", "~~~", "````"])
        return rng.choice(
            [
                lambda: [("markdown", "#" * rng.randint(1, 6) + " "), ("text", noun())], lambda: [("text", noun() + "\n"), ("markdown", rng.choice("=-") * rng.randint(3, 16))],
                lambda: [x for _ in range(3) for x in (("markdown", f"{mark} **"), ("text", noun()), ("markdown", "**"), ("text", f": {n()}\n"))],
                lambda: [x for k in range(3) for x in (("markdown", "  " * (k % 2) + f"{mark} ["), ("text", noun()), ("markdown", f"](#s-{n()})"), ("text", "\n"))],
                lambda: [("markdown", fence + rng.choice(["", "python", "c"]) + "\n"), ("text", f"x = {n()}\nfor k in range({n()}):\n    f(k)\n"), ("markdown", fence)],
                lambda: [("text", prose() + "設定は "), ("markdown", f"`a.b = {n()}`"), ("text", " とする。")], lambda: [("text", sentence()), ("markdown", "~~"), ("text", sentence()), ("markdown", "~~")],
                lambda: [("text", sentence() + "詳細は"), ("markdown", "["), ("text", noun()), ("markdown", f"](https://x.example/{n()})"), ("text", "を参照。")], lambda: [("markdown", "!["), ("text", noun()), ("markdown", f"](f/{n()}.png)")],
                lambda: [("markdown", "| "), ("text", noun()), ("markdown", " | "), ("text", n()), ("markdown", " |\n|---|:---:|\n| "), ("text", noun()), ("markdown", " | "), ("text", n()), ("markdown", " |")],
                lambda: [x for _ in range(2) for x in (("markdown", "> "), ("text", sentence() + "\n"))], lambda: [("text", sentence()), ("markdown", f"[^{n()}]"), ("text", "\n"), ("markdown", f"[^{n()}]:"), ("text", " " + sentence())],
                lambda: [("text", noun()), ("markdown", (w := rng.choice(["**", "***", "__", "*"]))), ("text", noun()), ("markdown", w), ("text", sentence())],
                lambda: [x for k in range(3) for x in (("markdown", f"{mark} "), ("text", sentence() + "\n"))] + [("markdown", "**"), ("text", noun()), ("markdown", "**")],
                lambda: [*latex_inline()],
            ]
        )()

    def latex_inline() -> list[tuple[str, str]]:
        a = rng.choice("abcmxyz")
        return [("text", noun() + "を "), ("latex", rng.choice([f"${a}_{n(1, 9)} = \\frac{{{a}}}{{{n(2, 9)}}}$", f"${a}^2$", f"\\({a}(x)\\)", f"$\\alpha = {n()}$", f"${a}$"])), ("text", " と定義する。")]

    def wiki_block() -> list[tuple[str, str]]:
        return rng.choice(
            [
                lambda: [("wiki", (w := "=" * rng.randint(2, 5))), ("text", f" {noun()} "), ("wiki", w)], lambda: [("wiki", "'''"), ("text", noun()), ("wiki", "'''"), ("text", "とは、"), ("wiki", "''"), ("text", noun()), ("wiki", "''"), ("text", "である。")],
                lambda: [x for _ in range(3) for x in (("wiki", rng.choice(["* [[", "** [[", "# [["])), ("text", noun()), ("wiki", "]]"), ("text", noun() + "\n"))], lambda: [("text", prose()), ("wiki", "[["), ("text", noun()), ("wiki", "|" + noun() + "]]"), ("text", sentence())],
                lambda: [("wiki", f"{{{{情報\n|名称={noun()}\n|値={n()}\n}}}}")], lambda: [("text", sentence()), ("wiki", f"{{{{要出典|{n(1990, 2024)}年}}}}")], lambda: [("text", sentence()), ("wiki", f"[https://w.example/{n()} "), ("text", noun()), ("wiki", "]")],
                lambda: [("wiki", f'{{| class="wikitable"\n! {noun()} !! {noun()}\n|-\n| {noun()} || {n()}\n|}}')], lambda: [("wiki", f"[[ファイル:{n()}.png|thumb|{noun()}]]")], lambda: [("wiki", f"[[Category:{noun()}]]")],
                lambda: [("wiki", "; "), ("text", noun() + "\n"), ("wiki", ": "), ("wiki", "[["), ("text", noun()), ("wiki", "]]"), ("text", noun())], lambda: [("wiki", f"#転送 [[{noun()}]]")], lambda: [("text", sentence()), ("wiki", "<ref>"), ("text", noun()), ("wiki", "</ref>")],
                lambda: [x for _ in range(3) for x in (("wiki", "* "), ("text", sentence() + "\n"))] + [("wiki", "[["), ("text", noun()), ("wiki", "]]")],
            ]
        )()

    def latex_block() -> list[tuple[str, str]]:
        a = rng.choice("abcmxyz")
        return rng.choice(
            [
                lambda: [("latex", rng.choice(["\\section{", "\\subsection*{", "\\chapter{"])), ("text", noun()), ("latex", "}" + rng.choice(["", f"\\label{{sec:{n()}}}"]))],
                lambda: [("latex", "\\begin{itemize}\n"), *[x for _ in range(3) for x in (("latex", "\\item "), ("text", sentence() + "\n"))], ("latex", "\\end{itemize}")],
                lambda: [("latex", f"\\begin{{equation}}\n{a} = \\sqrt{{{n()}^2 + \\mu}} \\label{{eq:{n()}}}\n\\end{{equation}}")], lambda: [("latex", f"$$\n\\dot{{{a}}} + {n()}\\omega = 0\n$$")], lambda: [("latex", f"\\[ \\sum_{{i=1}}^{{{n()}}} {a}_i \\]")],
                lambda: [("latex", f"\\begin{{tabular}}{{lr}}\n\\hline\n{noun()} & {n()} \\\\\n{noun()} & {n()} \\\\\n\\hline\n\\end{{tabular}}")], lambda: [("latex", "\\textbf{"), ("text", noun()), ("latex", "}"), ("text", "は図"), ("latex", f"~\\ref{{fig:{n()}}}"), ("text", "による"), ("latex", f"\\cite{{r{n()}}}"), ("text", "。")],
                lambda: [("text", sentence()), ("latex", "\\footnote{"), ("text", sentence()), ("latex", "}")], lambda: latex_inline(), lambda: [("latex", f"% {noun()}\n\\section{{"), ("text", noun()), ("latex", "}")],
            ]
        )()

    return {"text": text_block, "html": html_block, "markdown": markdown_block, "wiki": wiki_block, "latex": latex_block}


def labelled_page(rng: random.Random) -> tuple[str, str, list[str]]:
    """A page's main language, its text and the label of every character."""
    write = _grammar(rng)
    main = rng.choice(LABELS)
    second = rng.choice(LABELS)
    pieces: list[tuple[str, str]] = []
    for _ in range(rng.randint(1, 6)):
        kind = rng.random()
        label = main if kind < 0.5 else "text" if kind < 0.85 or main == "text" else second
        pieces += write[label]()
        pieces.append(("text", rng.choice(["\n\n", "\n\n", "\n"])))
    text = "".join(p for _, p in pieces)
    return main, text, [label for label, p in pieces for _ in p]


class Model(NamedTuple):
    """Log potentials of page, page to block, block to construct, and construct to form."""

    page: np.ndarray
    block: np.ndarray
    leaf: np.ndarray
    form: np.ndarray


@lru_cache(maxsize=1)
def model(pages: int = PAGES, seed: int = 11) -> Model:
    """Potentials counted on labelled pages, with a little added to every count."""
    rng = random.Random(seed)
    k = len(LABELS)
    number = {n: i for i, n in enumerate(LABELS)}
    page, block, leaf, form = np.full(k, 1.0), np.full((k, k), 0.5), np.full((k, k), 0.2), np.full((k, len(FORMS)), 0.02)
    for _ in range(pages):
        main, text, labels = labelled_page(rng)
        page[number[main]] += 1
        found, n = constructs(text)
        of_block: list[list[int]] = [[] for _ in range(n)]
        for c in found:
            inside = labels[c.start : c.end]
            kinds = [x for x in inside if x != "text"]
            label = number[max(set(kinds), key=kinds.count)] if kinds else 0
            form[label, c.form] += 1
            of_block[c.block].append(label)
        for own in of_block:
            marked = [x for x in own if x]
            b = max(set(marked), key=marked.count) if marked else 0
            block[number[main], b] += 1
            for x in own:
                leaf[b, x] += 1
    norm = lambda x: np.log(x / x.sum(-1, keepdims=True))
    return Model(norm(page), norm(block), norm(leaf), norm(form))


def _sum_exp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


def marginals(forms: np.ndarray, block: np.ndarray, page: np.ndarray, m: Model) -> np.ndarray:
    """Each construct's probability of each label, by messages up and down its tree.

    ``block`` gives every construct's block, ascending from 0, and ``page``
    every block's page, ascending from 0; blocks and pages without constructs
    are left out.
    """
    emit = m.form[:, forms].T  # what the form says of the label
    up = _sum_exp(m.leaf[None] + emit[:, None, :], 2)  # construct to block: by the block's label
    first = np.flatnonzero(np.diff(block, prepend=-1))
    at_block = np.add.reduceat(up, first)
    up_block = _sum_exp(m.block[None] + at_block[:, None, :], 2)  # block to page
    at_page = m.page + np.add.reduceat(up_block, np.flatnonzero(np.diff(page, prepend=-1)))
    down_block = _sum_exp((at_page[page] - up_block)[:, :, None] + m.block[None], 1)  # page to block, without what came from it
    belief = at_block + down_block
    down = _sum_exp((belief[block] - up)[:, :, None] + m.leaf[None], 1)  # block to construct
    joint = emit + down
    return np.exp(joint - _sum_exp(joint, 1)[:, None])


def read(texts: list[str | None]) -> list[list[tuple[int, int, str, float]]]:
    """For each text its constructs as ``(start, end, label, probability)`` of the likeliest label."""
    found: list[list[Construct]] = []
    block, page, forms = [], [], []
    owners = []
    for i, x in enumerate(texts):
        own = constructs(x)[0] if x else []
        found.append(own)
        seen: dict[int, int] = {}
        for c in own:
            if c.block not in seen:
                seen[c.block] = len(page)
                page.append(i)
            block.append(seen[c.block])
            forms.append(c.form)
            owners.append(i)
    out: list[list[tuple[int, int, str, float]]] = [[] for _ in texts]
    if not forms:
        return out
    order = np.argsort(np.array(block), kind="stable")
    pages = np.unique(np.array(page), return_inverse=True)[1]
    p = np.empty((len(forms), len(LABELS)))
    p[order] = marginals(np.array(forms)[order], np.array(block)[order], pages, model())
    best, value = p.argmax(1), p.max(1)
    flat = [c for own in found for c in own]
    for i, c, b, v in zip(owners, flat, best, value, strict=True):
        out[i].append((c.start, c.end, LABELS[b], float(v)))
    return out


#: Forms that never make a finding alone: they also stand in plain text, and only say how a block goes on.
_ALONE = {"star", "stars", "dash", "semicolon", "bar", "bars", "low", "tilde", "tick", "bang", "angle", "amp", "quote", "brace", "brace_close", "bracket", "dollar", "caret", "number", "price", "path", "percent", "underline", "hash_number", "row_break", "parameter"}


def languages(text: str, nodes: list[tuple[int, int, str, float]], least: float = 0.5) -> list[str]:
    """Languages with a construct that is more likely theirs than anything else and more than a list mark."""
    own = constructs(text)[0]
    names = {label for (_, _, label, p), c in zip(nodes, own, strict=True) if label != "text" and p >= least and FORMS[c.form] not in _ALONE}
    return [x for x in LABELS if x in names]


# --- clean text -----------------------------------------------------------


def _heading(x: str) -> str:
    return f"\n\n{x.strip()}\n\n"


def _indent(x: str) -> str:
    return "\n".join("    " + line if line.strip() else line for line in x.strip("\n").split("\n"))


def _block(x: str) -> str:
    return "\n\n" + x.strip() + "\n\n"


#: Nodes whose inside is no markup of the text's: code and formulas, by the languages that write them so.
_LEAVES = {
    "markdown": [r"^[ \t]*(?P<fence>`{3,}|~{3,})[^\n`]*\n(?P<fenced>(?:.*\n)*?)(?:[ \t]*(?P=fence)[`~]*[ \t]*$|\Z)", r"(?P<tick>`+)(?P<ticked>[^`\n]+)(?P=tick)(?!`)"],
    "latex": [
        r"\\begin\{(?P<verb>[Vv]erbatim|lstlisting|minted|alltt)\*?\}(?:\[[^\]\n]*\])?(?:\{[^}\n]*\})?\n?(?P<verbatim>(?s:.*?))\\end\{(?P=verb)\*?\}", r"\\verb\*?(?P<bar>[^\sA-Za-z*])(?P<barred>[^\n]*?)(?P=bar)",
        r"\\begin\{(?P<env>equation|align|gather|multline|eqnarray|displaymath|flalign|alignat)(?P<star>\*?)\}(?P<shown>(?s:.*?))\\end\{(?P=env)(?P=star)\}", r"\$\$(?P<dollars>(?s:.*?))\$\$", r"\\\[(?P<display>(?s:.*?))\\\]", r"\\\((?P<inline>[^\n]*?)\\\)",
        r"\$(?=[^\s$])(?P<math>[A-Za-z][^$\n]*|[^$\n\\^_{}=]*[\\^_{}=][^$\n]*)(?<=\S)\$",
    ],
    "html": [r"<(?i:pre)\b[^>]*>(?P<pre>(?s:.*?))</(?i:pre)\s*>", r"<(?i:code|kbd|samp|tt)\b[^>]*>(?P<code>(?s:.*?))</(?i:code|kbd|samp|tt)\s*>"],
    "wiki": [r"<(?i:nowiki)>(?P<nowiki>(?s:.*?))</(?i:nowiki)\s*>", r"<(?i:syntaxhighlight|source|pre)\b[^>]*>(?P<highlight>(?s:.*?))</(?i:syntaxhighlight|source|pre)\s*>", r"<(?i:math)\b[^>]*>(?P<formula>(?s:.*?))</(?i:math)\s*>"],
}


@lru_cache(maxsize=32)
def _leaves(found: tuple[str, ...]) -> re.Pattern:
    return re.compile("|".join([PAGE_MARK.pattern, "(?P<private>[\ue010\ue011])", *(p for name in found for p in _LEAVES[name])]), re.M)


def _untagged(x: str) -> str:
    return html.unescape(re.sub(r"</?(?:" + "|".join(_HTML) + r")\b[^<>]*>", "", x, flags=re.I))


def _leaf(m: re.Match) -> str:
    """What a code or formula node comes out as: its inside, untouched, code of several lines indented."""
    g = {k: v for k, v in m.groupdict().items() if v is not None}
    for name in ("fenced", "verbatim", "highlight", "pre"):
        if name in g:
            return "\n\n" + _indent(_untagged(g[name]) if name == "pre" else g[name]) + "\n\n"
    for name in ("shown", "dollars", "display"):
        if name in g:
            return _block(re.sub(r"\\label\{[^{}]*\}", "", g[name]))
    if "code" in g:
        return _untagged(g["code"])
    return next((g[name] for name in ("ticked", "barred", "inline", "math", "nowiki", "formula") if name in g), m[0])


#: Inline forms that stay as they are where the page's tree says that they are content.
_CONTENT = {"star_em", "star_strong", "star", "low_strong", "magic", "low", "strike", "tie", "tilde", "code", "tick", "math", "math_name", "price", "dollar", "dollars", "quote_em", "quote_strong", "quote", "word", "path", "percent", "template", "number", "entity", "amp", "angle", "caret", "display", "command", "wiki_link", "link", "ref_link", "footnote"}


def _held(text: str, found: list[str], content: list[tuple[int, int]]) -> tuple[str, list[str]]:
    """The text with code, formulas, page marks and stretches of content taken out, and what to put back for each."""
    kept: list[str] = []
    out: list[str] = []
    at = 0
    spans = [(m.start(), m.end(), _leaf(m)) for m in _leaves(tuple(found)).finditer(text)]
    spans += [(s, e, text[s:e]) for s, e in content]
    for s, e, put in sorted(spans, key=lambda x: (x[0], -x[1])):
        if s < at or s == e:
            continue
        out += [text[at:s], f"\ue010{len(kept)}\ue011"]
        kept.append(put)
        at = e
    return "".join([*out, text[at:]]), kept


def _from_html(x: str) -> str:
    i = re.I | re.S
    x = re.sub(r"<(style|script|noscript)\b[^>]*>.*?</\1\s*>", "", x, flags=i)
    x = re.sub(r"<!--.*?-->|<!DOCTYPE[^>]*>", "", x, flags=i)
    x = re.sub(r"<h([1-6])\b[^>]*>(.*?)</h\1\s*>", lambda m: _heading(m[2]), x, flags=i)
    x = re.sub(r"\s*</t[dh]\s*>\s*<t[dh]\b[^>]*>\s*", "\t", x, flags=i)
    x = re.sub(r"</tr\s*>\s*<tr\b[^>]*>\s*(?:<t[dh]\b[^>]*>)?", "\n", x, flags=i)
    x = re.sub(r"<tr\b[^>]*>\s*(?:<t[dh]\b[^>]*>)?|</tr\s*>", "\n", x, flags=i)
    x = re.sub(r"[ \t]*<li\b[^>]*>\s*", "\n・", x, flags=i)
    x = re.sub(r"<img\b[^>]*?\balt\s*=\s*(?:\"([^\"]*)\"|'([^']*)')[^>]*>", lambda m: m[1] or m[2] or "", x, flags=i)
    x = re.sub(r"<(?:br|hr)\b[^>]*>", "\n", x, flags=i)
    x = re.sub(r"</?(?:p|div|table|ul|ol|dl|dt|dd|figure|figcaption|section|article|blockquote|tbody|thead|header|footer|nav|form|center)\b[^>]*>", "\n\n", x, flags=i)
    x = re.sub(r"</?(?:" + "|".join(_HTML) + r")\b[^<>]*>", "", x, flags=i)
    return html.unescape(x)


def _from_markdown(x: str) -> str:
    m = re.M
    x = re.sub(r"^#{1,6}[ \t]+(.+?)[ \t]*#*[ \t]*$", lambda k: _heading(k[1]), x, flags=m)
    x = re.sub(r"^(?=\S)(.+)\n(?:={3,}|-{3,})[ \t]*$", lambda k: _heading(k[1]), x, flags=m)
    x = re.sub(r"!\[([^\]\n]*)\]\([^)\n]*\)", r"\1", x)
    x = re.sub(r"\[([^\[\]\n]+)\]\((?:https?://|#|/|\.|mailto:|[\w-]+[./])[^)\s]*(?:\s\"[^\"\n]*\")?\)", r"\1", x)
    x = re.sub(r"^\[\^([^\]\s]+)\]:[ \t]*", "注: ", x, flags=m)
    x = re.sub(r"\[\^[^\]\s]+\]", "", x)
    x = re.sub(r"^\|?[ \t]*:?-{3,}:?[ \t]*(?:\|[ \t]*:?-{3,}:?[ \t]*)+\|?[ \t]*\n?", "", x, flags=m)
    x = re.sub(r"^\|[ \t]*(.+?)[ \t]*\|[ \t]*$", lambda k: re.sub(r"[ \t]*\|[ \t]*", "\t", k[1]), x, flags=m)
    x = re.sub(r"^[ \t]*>+[ \t]?", "", x, flags=m)
    x = re.sub(r"^([ \t]*)[-*+][ \t]+", r"\1・", x, flags=m)
    x = re.sub(r"~~(?=\S)([^~\n]+?)(?<=\S)~~", r"\1", x)
    x = re.sub(r"\*{2,3}(?=\S)([^*\n]+?)(?<=\S)\*{2,3}", r"\1", x)
    x = re.sub(r"(?<![A-Za-z0-9_])__(?=\S)([^_\n]+?)(?<=\S)__", r"\1", x)
    return re.sub(r"(?<![*\w])\*(?=[^\s*])([^*\n]+?)(?<=[^\s*])\*(?![*\w])", r"\1", x)


def _from_wiki(x: str) -> str:
    m = re.M
    x = re.sub(r"<ref\b[^>]*>(.*?)</ref\s*>", r"（\1）", x, flags=re.I | re.S)
    x = re.sub(r"</?(?:" + "|".join(_WIKI) + r")\b[^<>]*>", "", x, flags=re.I)
    before = None
    while before != x:  # templates in templates, from the inside
        before = x
        x = re.sub(r"\{\{(?:要出典|Citation needed|出典の明記)[^{}]*\}\}", "", x, flags=re.I)
        x = re.sub(r"^\{\{([^{}|\n]+)\n((?:\|[^\n]*\n)+)\}\}", lambda k: k[1] + "\n" + re.sub(r"^\|[ \t]*([^=\n]+?)[ \t]*=[ \t]*", r"\1: ", k[2], flags=m), x, flags=m)
        x = re.sub(r"\{\{([^{}\n]*)\}\}", lambda k: k[1].split("|")[-1].split("=")[-1], x)
    x = re.sub(r"^\{\|.*$|^\|\}[ \t]*$|^\|-+.*$", "", x, flags=m)
    x = re.sub(r"^[!|][ \t]*(.+?(?:!!|\|\|).*)$", lambda k: re.sub(r"[ \t]*(?:!!|\|\|)[ \t]*", "\t", k[1]), x, flags=m)
    x = re.sub(r"\[\[(?:Category|カテゴリ):[^\[\]\n]+\]\]", "", x, flags=re.I)
    x = re.sub(r"\[\[(?:ファイル|File|Image|画像):[^\[\]\n]+\]\]", lambda k: k[0][2:-2].split("|")[-1] if "|" in k[0] else "", x, flags=re.I)
    x = re.sub(r"^#(?:転送|REDIRECT)[ \t]*\[\[([^\[\]\n]+)\]\]", r"→ \1", x, flags=m | re.I)
    x = re.sub(r"\[\[(?:[^\[\]|\n]*\|)?([^\[\]|\n]+)\]\]", r"\1", x)
    x = re.sub(r"\[(?:https?|ftp)://[^\s\]]+ ([^\]\n]+)\]", r"\1", x)
    x = re.sub(r"^(={2,6})[ \t]*([^=\n].*?)[ \t]*\1[ \t]*$", lambda k: _heading(k[2]), x, flags=m)
    x = re.sub(r"'{2,5}([^'\n]+)'{2,5}", r"\1", x)
    x = re.sub(r"^([*#]+)[ \t]*", lambda k: "  " * (len(k[1]) - 1) + "・", x, flags=m)
    x = re.sub(r"^[;:]+[ \t]*", "", x, flags=m)
    return re.sub(r"__[A-Z]{3,}__", "", x)


_COMMAND = re.compile(r"\\([A-Za-z]+)\*?(?:\[[^\]\n]*\])?\{|[{}\\]")
# Commands by what becomes of them.
_HEADS = {"part", "chapter", "section", "subsection", "subsubsection", "paragraph", "subparagraph"}
_SHOWN = {"textbf", "textit", "texttt", "emph", "underline", "textsc", "textrm", "textsf", "mbox", "hbox", "caption", "title", "author", "date", "text", "uline"}
_CITES = {"cite", "citep", "citet", "ref", "eqref", "pageref", "autoref"}
_FACE = re.compile(r"\\(?:bf|it|em|tt|sc|rm|sf|sl|bfseries|itshape|ttfamily|scshape|small|large|Large|footnotesize|normalsize)\b[ \t]*")


def _commands(x: str) -> str:
    """Commands with arguments, from the inside out: each argument is a node that holds what is written in it."""
    nodes: list[tuple[str, list[str]]] = [("", [])]  # what opened the node, and what came out of it so far
    at = 0
    for m in _COMMAND.finditer(x):
        if m.start() < at:
            continue
        nodes[-1][1].append(x[at : m.start()])
        at = m.end()
        if m[0] == "\\":  # an escaped sign, or a command without argument
            nodes[-1][1].append(x[m.start() : m.end() + 1])
            at += 1
        elif m[0] != "}":
            nodes.append((m[0], []))
        elif len(nodes) > 1:
            opened, inside = nodes.pop()
            nodes[-1][1].append(_command(opened, "".join(inside)))
        else:
            nodes[-1][1].append("}")
    nodes[-1][1].append(x[at:])
    while len(nodes) > 1:  # never closed: as it was
        opened, inside = nodes.pop()
        nodes[-1][1].append(opened + "".join(inside))
    return "".join(nodes[0][1])


def _command(opened: str, inside: str) -> str:
    """What becomes of a command with its argument, or of a group."""
    if opened == "{":
        face = _FACE.match(inside)
        return inside[face.end() :] if face else "{" + inside + "}"
    name = re.match(r"\\([A-Za-z]+)", opened)[1]
    if name in _HEADS:
        return _heading(inside)
    if name == "label":
        return ""
    if name in _SHOWN:
        return inside
    if name == "footnote":
        return f"（{inside}）"
    if name in _CITES:
        return f"[{inside}]"
    return opened + inside + "}"


def _from_latex(x: str) -> str:
    m = re.M
    x = re.sub(r"^%.*\n?", "", x, flags=m)
    x = re.sub(r"\\begin\{tabular\}(?:\[[^\]]*\])?\{[^{}]*\}(.*?)\\end\{tabular\}", lambda k: "\n" + "\n".join(re.sub(r"[ \t]*(?<!\\)&[ \t]*", "\t", r.strip()) for r in re.split(r"\\\\|\\hline", k[1]) if r.strip()) + "\n", x, flags=re.S)
    x = re.sub(r"[ \t]*\\item(?:\[[^\]]*\])?[ \t]*", "・", x)
    x = re.sub(r"\\(?:begin|end)\{[A-Za-z]+\*?\}(?:\[[^\]]*\])?", "\n", x)
    x = _commands(x)
    x = re.sub(r"\\hline\b", "", x)
    return re.sub(r"~(?=\[)", " ", x)


_CLEAN = {"wiki": _from_wiki, "markdown": _from_markdown, "latex": _from_latex, "html": _from_html}


def clean_text(text: str, found: list[str], nodes: list[tuple[int, int, str, float]] | None = None) -> str:
    """The text without the markup found in it.

    Headings stand alone between blank lines, list entries begin with a middle
    dot, table rows keep their lines with cells parted by tabs, code of several
    lines is indented. The insides of code and formulas come out as they are,
    and so do the constructs that ``nodes``, the marginals of the page's tree,
    call content. Page marks stay.
    """
    if not found:
        return text
    content = []
    if nodes:
        content = [(start, end) for (start, end, label, _), c in zip(nodes, constructs(text)[0], strict=True) if label == "text" and FORMS[c.form] in _CONTENT]
    text, kept = _held(text, found, content)
    for name in ("wiki", "markdown", "latex", "html"):
        if name in found:
            text = _CLEAN[name](text)
    text = re.sub("\ue010(\\d+)\ue011", lambda m: kept[int(m[1])], text)
    text = re.sub(r"(?<![ \t])[ \t]+(?=\n|\Z)", "", text)
    return re.sub(r"\n{3,}", "\n\n", text).strip("\n")


def may_hold(text: Column) -> Column:
    """False for texts without a single sign that a construct begins with; page marks don't count."""
    return F.regexp_replace(text, r"<!-- Page \d+ -->", "").rlike(_NEEDS)


def found(df: DataFrame, key: str = "id", text: str = "text") -> DataFrame:
    """``(key, markup)``: each language found in each text, rows delivered again included. Null text has none."""
    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = list(b["x"])
            rows = [(k, name) for k, x, nodes in zip(b["k"], texts, read(texts), strict=True) for name in languages(x, nodes)]
            yield pd.DataFrame(rows, columns=["k", "markup"])

    rows = df.where(may_hold(F.col(text))).select(F.col(key).alias("k"), F.col(text).alias("x"))
    return rows.mapInPandas(run, f"k {kind}, markup string").select(F.col("k").alias(key), "markup")


def cleaned(df: DataFrame, text: str = "text", out: str = "clean") -> DataFrame:
    """``df`` with ``out``, the text without markup, and ``markup``, the languages found; null stays null with none.

    Texts that cannot hold markup do not go through the model.
    """

    @F.pandas_udf("clean string, markup array<string>")
    def run(s: pd.Series) -> pd.DataFrame:
        texts = list(s)
        nodes = read(texts)
        names = [languages(x, own) if x else [] for x, own in zip(texts, nodes, strict=True)]
        return pd.DataFrame({"clean": [x if not n else clean_text(x, n, own) for x, n, own in zip(texts, names, nodes, strict=True)], "markup": names})

    needs = may_hold(F.col(text))
    done = run(F.when(needs, F.col(text)))
    df = df.withColumn("__m", done)
    return df.withColumn(out, F.when(needs, F.col("__m.clean")).otherwise(F.col(text))).withColumn("markup", F.when(needs, F.col("__m.markup")).otherwise(F.array().cast("array<string>"))).drop("__m")

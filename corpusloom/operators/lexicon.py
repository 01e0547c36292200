"""Dictionary operators: definition texts, and terms found, explained or replaced in texts.

A *surface* is a headword or one of its synonyms. Surfaces are tried from long
to short; equal lengths in the order in which they first appear in the
dictionary, while the entry used is the one that names them last.

The surfaces travel to the workers in slices of at most ``SLICE`` entries, each
of a size that is checked; a larger dictionary takes more slices, applied one
after another, which gives the same result because surfaces are tried in order.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappop, heappush

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

#: Surfaces sent to the workers at once.
SLICE = 20_000
#: Characters of one surface's entry that a slice may hold; longer definitions are cut out of the slice and joined later.
LOG = T.ArrayType(T.StructType([T.StructField("term", T.StringType()), T.StructField("headword", T.StringType()), T.StructField("explanation", T.StringType())]))
STATE = T.StructType([T.StructField("text", T.StringType()), T.StructField("log", LOG)])


def surfaces(terms: DataFrame) -> DataFrame:
    """``(surface, ord, entry)``: first position and last entry of every surface.

    Terms without a headword and empty synonyms give none. ``entry`` holds the
    term's columns; null definitions count as empty.
    """
    spoken = terms.where(F.coalesce("headword", F.lit("")) != "")
    forms = F.concat(F.array("headword"), F.coalesce("synonyms", F.array().cast("array<string>")))
    rows = spoken.select(F.struct(*terms.columns).alias("entry"), F.posexplode(forms).alias("k", "surface")).where(F.coalesce("surface", F.lit("")) != "")
    at = F.struct(F.col("entry.pos").cast("long").alias("pos"), F.col("k"))
    return rows.groupBy("surface").agg(F.min(at).alias("ord"), F.max_by("entry", at).alias("entry"))


def _slices(terms: DataFrame) -> list[list[tuple[str, str, str]]]:
    """Surfaces in the order they are tried, in slices: ``(surface, headword, brief definition)``."""
    rows = surfaces(terms).select("surface", "ord", F.col("entry.headword").alias("h"), F.coalesce("entry.brief_definition", F.lit("")).alias("b"))
    rows = rows.orderBy(F.length("surface").desc(), "ord").select("surface", "h", "b")
    out: list[list[tuple[str, str, str]]] = [[]]
    for r in rows.toLocalIterator():
        if len(out[-1]) == SLICE:
            out.append([])
        out[-1].append((r["surface"], r["h"], r["b"]))
    return out


def _fold(slice_: list[tuple[str, str, str]], replace: bool):
    """One pass over a slice of surfaces, in their order.

    An automaton finds the surfaces in the text, so those that aren't there cost
    nothing. What is put in may complete further surfaces: the automaton looks
    again at the new stretch and its surroundings, and those still to be tried
    join in. A surface found is looked for once more when its turn comes.
    """
    widest = max((len(term) for term, _, _ in slice_), default=0)
    built: list = []

    def automaton():
        if not built:
            import ahocorasick

            a = ahocorasick.Automaton()
            for i, (term, _, brief) in enumerate(slice_):
                if brief:
                    a.add_word(term, i)
            if len(a):
                a.make_automaton()
            built.append(a)
        return built[0]

    def step(state: pd.DataFrame) -> pd.DataFrame:
        a = automaton()
        texts, logs = [], []
        for text, log in zip(state["text"], state["log"], strict=True):
            log = [] if log is None else list(log)
            used = {x["headword"] for x in log}
            if text and len(a):
                seen = {i for _, i in a.iter(text)}
                todo = sorted(seen)
                while todo:
                    i = heappop(todo)
                    term, head, brief = slice_[i]
                    at = text.find(term)
                    if at < 0 or (not replace and head in used):
                        continue
                    said = brief
                    if replace:
                        said = brief.split("。")[0]
                        said = said[:50] + "..." if len(said) > 50 else said
                        new = said
                    else:
                        new = f"{term}（{brief}）"
                        used.add(head)
                    text = text[:at] + new + text[at + len(term) :]
                    log.append({"term": term, "headword": head, "explanation": said})
                    for _, k in a.iter(text[max(0, at - widest) : at + len(new) + widest]):
                        if k > i and k not in seen:
                            seen.add(k)
                            heappush(todo, k)
            texts.append(text)
            logs.append(log)
        return pd.DataFrame({"text": texts, "log": logs})

    return F.pandas_udf(step, STATE)


def _folded(df: DataFrame, terms: DataFrame, text: str, replace: bool) -> DataFrame:
    state = F.struct(F.col(text).alias("text"), F.array().cast(LOG).alias("log"))
    df = df.withColumn("__state", state)
    for slice_ in _slices(terms):
        df = df.withColumn("__state", _fold(slice_, replace)("__state"))
    return df


def elaborate(df: DataFrame, terms: DataFrame, text: str = "text") -> DataFrame:
    """The first occurrence of each term explained in brackets, once per headword.

    Later terms also match inside explanations put in before. All rows come
    out, with ``elaborations``; null text stays null with an empty list.
    """
    log = F.transform("__state.log", lambda x: F.struct(x["term"].alias("term"), x["headword"].alias("headword"), x["explanation"].alias("explanation")))
    return _folded(df, terms, text, replace=False).withColumn("elaborations", log).withColumn(text, F.col("__state.text")).drop("__state")


def generalize(df: DataFrame, terms: DataFrame, text: str = "text", changed_only: bool = False) -> DataFrame:
    """The first occurrence of every surface replaced by the first sentence of its brief definition.

    At most 50 characters are put in. ``changed_only`` drops rows without a
    replacement. Null text stays null.
    """
    log = F.transform("__state.log", lambda x: F.struct(x["term"].alias("original"), x["explanation"].alias("replaced"), x["headword"].alias("headword")))
    df = _folded(df, terms, text, replace=True).withColumn("replacements", log).withColumn(text, F.col("__state.text")).drop("__state")
    return df.where(F.size("replacements") > 0) if changed_only else df


def augmented(df: DataFrame, kind: str, *logs: str, text: str = "text", id: str = "id") -> DataFrame:
    """Augmented rows as they are written: text, ``augmentation_type``, the logs of what was changed, and ``source_id``, empty where there is no id."""
    source = F.coalesce(F.col(id).cast("string"), F.lit("")) if id in df.columns else F.lit("")
    return df.select(F.col(text).alias("text"), F.lit(kind).alias("augmentation_type"), *logs, source.alias("source_id"))


def find_terms(df: DataFrame, terms: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``(key, rank, surface, entry)`` of the terms in each text, one per headword, in the order tried.

    Each slice is one pass with an Aho-Corasick automaton, so the cost does not
    depend on the size of the dictionary; only surfaces found are joined with
    their entries.
    """
    slices = _slices(terms)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import ahocorasick

        automata = []
        for s, slice_ in enumerate(slices):
            a = ahocorasick.Automaton()
            for i, (surface, head, _) in enumerate(slice_):
                a.add_word(surface, (s * SLICE + i, head))
            if slice_:
                a.make_automaton()
                automata.append(a)
        for batch in batches:
            out = []
            for k, x in zip(batch["k"], batch["x"], strict=True):
                if x is None:
                    continue
                hits = sorted({hit for a in automata for _, hit in a.iter(x)})
                seen: set[str] = set()
                for i, head in hits:
                    if head not in seen:
                        seen.add(head)
                        out.append((k, len(seen) - 1, slices[i // SLICE][i % SLICE][0]))
            yield pd.DataFrame(out, columns=["k", "rank", "surface"])

    kind = dict(df.dtypes)[key]
    found = df.select(F.col(key).alias("k"), F.col(text).alias("x")).mapInPandas(scan, f"k {kind}, rank int, surface string")
    return found.join(surfaces(terms).select("surface", "entry"), "surface").select(F.col("k").alias(key), "rank", "surface", "entry")


def extract_keywords(df: DataFrame, terms: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``(key, keywords, keyword_count)`` of rows with at least one term, most confident first.

    Ties keep the order in which terms are tried; a null confidence counts as 1.
    """
    found = find_terms(df, terms, key, text)
    word = F.struct(
        (-F.coalesce("entry.confidence", F.lit(1.0))).alias("less"),
        F.col("rank"),
        F.struct(
            F.col("entry.headword").alias("term"),
            F.coalesce("entry.synonyms", F.array().cast("array<string>")).alias("synonyms"),
            *[F.coalesce(f"entry.{c}", F.lit("")).alias(c) for c in ("domain", "brief_definition", "definition")],
            F.coalesce("entry.confidence", F.lit(1.0)).alias("confidence"),
        ).alias("word"),
    )
    words = F.transform(F.array_sort(F.collect_list(word)), lambda x: x["word"])
    return found.groupBy(key).agg(words.alias("keywords")).withColumn("keyword_count", F.size("keywords"))


def render_keywords(keywords: Column) -> Column:
    """Keywords as a Markdown section; no keywords give the empty string."""

    def line(label: str, value: Column) -> Column:
        return F.when(value != "", F.concat(F.lit(f"- **{label}**: "), value, F.lit("\n")))

    def one(k: Column) -> Column:
        also = F.when(F.size(k["synonyms"]) > 0, F.concat(F.lit("（別名: "), F.array_join(k["synonyms"], ", "), F.lit("）"))).otherwise("")
        parts = F.array(F.concat(F.lit("### "), k["term"], also, F.lit("\n")), line("分野", k["domain"]), line("概要", k["brief_definition"]), line("詳細", k["definition"]), F.lit(""))
        return F.array_join(F.filter(parts, lambda p: p.isNotNull()), "\n")

    body = F.concat(F.lit("## 専門用語解説\n\n"), F.array_join(F.transform(keywords, one), "\n"))
    return F.when(F.size(keywords) > 0, body).otherwise("")


def definition_texts(terms: DataFrame, form: str = "all") -> DataFrame:
    """``(pos, text, source)``: a definition text for the first entry of each headword.

    ``form`` is ``all``, ``definition``, ``simple`` or ``qa``; anything else is
    ``simple``. A first entry without any definition gives no text, and later
    entries of its headword don't stand in for it.
    """
    first = Window.partitionBy("headword").orderBy("pos")
    rows = terms.where(F.coalesce("headword", F.lit("")) != "").withColumn("__n", F.row_number().over(first)).where("__n = 1")
    brief, full = F.coalesce("brief_definition", F.lit("")), F.coalesce("definition", F.lit(""))
    from corpusloom.functions.rx import strip

    said = strip(F.when((brief != "") & (full != ""), F.concat(brief, F.lit("。"), full)).otherwise(F.concat(brief, full)))
    t, simple, definition, qa = F.col("headword"), "%s: %s", "%sとは、%s", "Q: %sとは何ですか？\nA: %s"
    shown = {
        "all": F.concat(t, F.lit(": "), said, F.lit("\n\n"), t, F.lit("とは、"), said, F.lit("\n\nQ: "), t, F.lit("とは何ですか？\nA: "), said),
        "definition": F.format_string(definition, t, said),
        "qa": F.format_string(qa, t, said),
    }.get(form, F.format_string(simple, t, said))
    return rows.where((brief != "") | (full != "")).select("pos", shown.alias("text"), F.lit("dictionary").alias("source"))


def pattern_texts(terms: DataFrame) -> DataFrame:
    """``(pos, n, text, source)``: up to six texts for each entry with a headword and a definition."""
    h, d, b = F.col("headword"), F.col("definition"), F.coalesce("brief_definition", F.lit(""))
    also = F.array_join(F.coalesce("synonyms", F.array().cast("array<string>")), "、")
    has_also = F.size(F.coalesce("synonyms", F.array().cast("array<string>"))) > 0
    texts = F.array(
        F.concat(h, F.lit("とは、"), d),
        F.concat(F.lit("質問: "), h, F.lit("とは何ですか？\n回答: "), d),
        F.concat(h, F.lit("について説明します。"), d),
        F.when(b != "", F.concat(h, F.lit("は"), b, F.lit("です。"))),
        F.when(b != "", F.concat(F.lit("質問: "), h, F.lit("を簡潔に説明してください。\n回答: "), b)),
        F.when(has_also, F.concat(h, F.lit("は"), also, F.lit("とも呼ばれます。"), d)),
    )
    rows = terms.where((F.coalesce("headword", F.lit("")) != "") & (F.coalesce("definition", F.lit("")) != ""))
    return rows.select("pos", F.posexplode(F.filter(texts, lambda x: x.isNotNull())).alias("n", "text")).withColumn("source", F.lit("dictionary"))

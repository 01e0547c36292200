"""Text generators behind one interface, and the steps that use them.

A generator is ``(prompts, system) -> answers``: lists of equal length, None for
a failure. Prompts are columns, built on the JVM; only prompt and answer cross
to Python, in Arrow batches, with a bounded pool of threads per task.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions import prompts, rx
from corpusloom.operators import relations

Generator = Callable[[str, str], str | None]


def echo(prompt: str, system: str) -> str | None:
    """An offline generator: the last line of the prompt and a digest, always the same."""
    digest = hashlib.sha1((system + "\0" + prompt).encode()).hexdigest()[:8]
    return f"[{digest}] {prompt.strip().splitlines()[-1] if prompt.strip() else ''}"


def stand_in(prompt: str, system: str) -> str | None:
    """``echo``, as JSON with three pairs where expert questions are asked for, so that every step has rows."""
    said = echo(prompt, system)
    if system != prompts.SYSTEM["qa_difficult"]:
        return said
    return json.dumps({"qa_pairs": [{"question": f"{said} {i}?", "answer": f"{said} {i}"} for i in (1, 2, 3)]}, ensure_ascii=False)


def measured(prompt: str, system: str) -> str | None:
    """An offline generator whose answer SQL can form too: the lengths of prompt and system, and the prompt's end."""
    return f"{len(prompt)} {len(system)} {prompt[-40:]}"


def measured_json(prompt: str, system: str) -> str | None:
    """``measured``, as JSON of whatever form is asked for; in a fence, with an entry that lacks a field where a list is asked for."""
    n, m = len(prompt), len(system)
    pair = lambda i: {"question": f"Q{i} {n}", "answer": f"A{i} {m} {n % 7}"}
    if system == prompts.SYSTEM["qa_difficult"]:
        return json.dumps({"qa_pairs": [pair(i) for i in range(2)]})
    if '[{"keyword"' in prompt:
        return "語:\n```json\n" + json.dumps([{"keyword": f"K{n}", "description": f"D{n % 7}"}, {"keyword": "", "description": "x"}, {"keyword": "L"}, {"keyword": "M", "description": str(m)}]) + "\n```"
    return f"答え: {json.dumps(pair(0))}" if "出力はJSON形式: {" in prompt else json.dumps(pair(0))


def answers(prompt: Column, generator: Generator = echo, system: str = "", threads: int = 3) -> Column:
    """The generator's answer; null where the prompt is null or the generator fails."""

    def one(p: str | None) -> str | None:
        if p is None:
            return None
        try:
            return generator(p, system)
        except Exception:  # noqa: BLE001 - one failing call must not fail the job
            return None

    @F.pandas_udf(T.StringType())
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        with ThreadPoolExecutor(threads) as pool:
            for batch in batches:
                yield pd.Series(list(pool.map(one, batch)), dtype="object")

    return run(prompt)


def _asked(prompt: Column, text: Column) -> Column:
    """The prompt; null, so that nothing is asked, where the text is null or blank."""
    return F.when(rx.strip(text) != "", prompt)


def rewrite(df: DataFrame, name: str, generator: Generator = echo, text: str = "text", **values: str) -> DataFrame:
    """Rows of ``{text, source}`` from one of the plain prompts; null and blank texts, failures and empty answers give no row."""
    variable = "context" if "{context}" in prompts.USER[name] else "text"
    prompt = _asked(prompts.render(name, **{variable: F.col(text)}, **values), F.col(text))
    out = df.withColumn(text, rx.strip(answers(prompt, generator)))
    return out.where(F.coalesce(F.col(text), F.lit("")) != "").withColumn("source", F.lit(name))


def question_answers(df: DataFrame, generator: Generator = echo, text: str = "text") -> DataFrame:
    """One pair per text; null and blank texts and answers without both fields give no row."""
    raw = answers(_asked(prompts.render("qa", context=F.col(text)), F.col(text)), generator)
    return _pairs(df, prompts.json_answer(raw, "question string, answer string"), text, "qa")


def focused_questions(df: DataFrame, focus: str, generator: Generator = echo, text: str = "text") -> DataFrame:
    """One pair per text about one focus; the answer's first braces hold it."""
    raw = answers(_asked(prompts.qa_focus_prompt(F.col(text), focus), F.col(text)), generator)
    found = F.regexp_extract(raw, r"(?s)(\{.*?\})", 1)
    return _pairs(df, F.from_json(F.when(found != "", found), "question string, answer string"), text, "specialized_qa")


def _pairs(df: DataFrame, pair: Column, text: str, source: str) -> DataFrame:
    """Rows of the pairs whose both fields hold something; a row's own ``question`` and ``answer`` are replaced."""
    kept = [c for c in df.columns if c not in ("question", "answer")]
    out = df.withColumn("__p", pair).where((F.coalesce("__p.question", F.lit("")) != "") & (F.coalesce("__p.answer", F.lit("")) != ""))
    return out.select(*kept, F.col("__p.question").alias("question"), F.col("__p.answer").alias("answer")).withColumn(text, prompts.qa_text(F.col("question"), F.col("answer"))).withColumn("source", F.lit(source))


def keyword_texts(df: DataFrame, generator: Generator = echo, text: str = "text") -> DataFrame:
    """A line ``keyword: description`` for each keyword of a text; entries without one of them are left out, and texts without any."""
    raw = answers(_asked(prompts.render("keywords", text=F.col(text)), F.col(text)), generator)
    entries = prompts.json_answer(raw, "array<struct<keyword:string,description:string>>", "[", "]")
    named = F.filter(entries, lambda k: (F.coalesce(k["keyword"], F.lit("")) != "") & k["description"].isNotNull())
    out = df.withColumn(text, F.array_join(F.transform(named, lambda k: F.concat(k["keyword"], F.lit(": "), k["description"])), "\n"))
    return out.where(F.coalesce(F.col(text), F.lit("")) != "").withColumn("source", F.lit("keywords"))


def difficult_questions(df: DataFrame, generator: Generator = echo, text: str = "text", terms: str = "terms") -> DataFrame:
    """Several expert pairs per text that has terms: one row each."""
    raw = answers(prompts.difficult_qa_prompt(F.col(text), F.col(terms)), generator, prompts.SYSTEM["qa_difficult"])
    pairs = F.from_json(raw, "qa_pairs array<struct<question:string,answer:string>>")["qa_pairs"]
    rows = df.withColumn("__q", F.explode(pairs))
    body = prompts.qa_text(F.col("__q.question"), F.col("__q.answer"), 2)
    return rows.select(*[c for c in df.columns if c != text], body.alias(text), F.col("__q.question").alias("question"), F.col("__q.answer").alias("answer"), F.lit("qa_difficult").alias("augmentation_type")).where(F.col(text).isNotNull())


def to_english(df: DataFrame, generator: Generator = echo, text: str = "text") -> DataFrame:
    """One row per text; where translating fails the text itself."""
    raw = answers(F.col(text), generator, prompts.SYSTEM["english_translation"])
    return df.withColumn(text, F.coalesce(raw, F.col(text))).withColumn("source", F.lit("english"))


def relation_texts(edges: DataFrame, generator: Generator = echo, max_chars: int = 100, max_nodes: int | None = None) -> DataFrame:
    """A text per node of the graph; empty answers give no row."""
    nodes = relations.node_relations(edges)
    nodes = relations.first_nodes(nodes, max_nodes) if max_nodes is not None else nodes
    prompt = prompts.render("graph_relations", node=F.col("node"), relations_formatted=relations.format_relations(F.col("relations")), max_chars=str(max_chars))
    out = nodes.withColumn("text", rx.strip(answers(prompt, generator, prompts.SYSTEM["graph_relations"])))
    return out.where(F.coalesce("text", F.lit("")) != "").withColumn("source", F.lit("graph_relations"))


def describe_tables(df: DataFrame, generator: Generator = echo, text: str = "text") -> DataFrame:
    """Every HTML table replaced by the generator's prose, set apart; where it fails or says nothing the table stays."""

    def said(m: re.Match) -> str:
        try:
            prose = generator(prompts.TABLE.format(table=m[0]), "")
        except Exception:  # noqa: BLE001 - one failing call must not fail the job
            prose = None
        return f"\n\n{prose}\n\n" if prose else m[0]

    def one(x: str | None) -> str | None:
        return None if x is None else re.sub(r"(?is)<table[^>]*>.*?</table>", said, x)

    @F.pandas_udf(T.StringType())
    def run(s: pd.Series) -> pd.Series:
        return s.map(one)

    has = F.col(text).rlike(r"(?is)<table[^>]*>.*?</table>")
    return df.withColumn(text, F.when(has, run(F.when(has, F.col(text)))).otherwise(F.col(text)))

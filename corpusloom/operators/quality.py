"""Row predicates: personal data, fragments, and a language-model score."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions import clean, rx

# What counts as personal data.
PHONE = r"\b\d{2,4}-\d{2,4}-\d{4}\b"
EMAIL = r"\b[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+\b"
CARD = r"\b\d{4}[- ]?\d{4}[- ]?\d{4}[- ]?\d{4}\b"
PERSONAL_NUMBER = r"\b\d{12}\b"


def is_safe(text: Column) -> Column:
    """Whether the text holds no phone, mail, card or personal number. Null is safe.

    Word borders are Unicode-aware: digits right after a Japanese letter don't count.
    """
    # a sign each form must hold is looked for first, and digits before word borders: the same result in less time
    phone = F.contains(text, F.lit("-")) & rx.searches(text, r"(?=\d)" + PHONE)
    mail = F.contains(text, F.lit("@")) & rx.searches(text, EMAIL)
    number = rx.searches(text, r"(?=\d{4})" + CARD) | rx.searches(text, r"(?=\d{12})" + PERSONAL_NUMBER)
    return ~F.coalesce(phone | mail | number, F.lit(False))


def drop_fragments(df: DataFrame, text: str = "text", min_chars: int = 50) -> DataFrame:
    """Rows whose text is a complete sentence; null counts as empty."""
    return df.where(clean.is_complete_sentence(F.col(text), min_chars))


Scorer = Callable[[list[str]], list[float]]


def trigram_scorer(sample: list[str]) -> Scorer:
    """Perplexity under an add-one character trigram model of ``sample``, a bounded list of texts."""
    from collections import Counter
    from math import exp, log

    tri: Counter[str] = Counter()
    bi: Counter[str] = Counter()
    for x in sample:
        x = "\x02\x02" + x
        tri.update(x[i : i + 3] for i in range(len(x) - 2))
        bi.update(x[i : i + 2] for i in range(len(x) - 1))
    size = len({c for g in bi for c in g}) + 1

    def score(texts: list[str]) -> list[float]:
        out = []
        for x in texts:
            y = "\x02\x02" + x
            loss = sum(log((bi[y[i : i + 2]] + size) / (tri[y[i : i + 3]] + 1)) for i in range(len(x)))
            out.append(exp(loss / max(1, len(x))))
        return out

    return score


def perplexity(text: Column, scorer: Scorer) -> Column:
    """The scorer's perplexity; null where the text is null or blank or the scorer fails."""

    @F.pandas_udf(T.DoubleType())
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = pd.Series([None] * len(batch), dtype="float64")
            has = batch.map(lambda x: x is not None and bool(x.strip()))
            try:
                out[has] = scorer(list(batch[has]))
            except Exception:  # noqa: BLE001 - a failing model must not drop rows
                pass
            yield out

    return run(text)


def filter_perplexity(df: DataFrame, scorer: Scorer, text: str = "text", below: float = 30_000.0) -> DataFrame:
    """Rows below the bound; rows without a score are kept."""
    return df.where(F.coalesce(perplexity(F.col(text), scorer), F.lit(0.0)) < below)

"""Token counts by a public tokenizer's vocabulary file.

The file is named by its path and read on the workers; nothing is trained or
copied. Counting is the only Python step of the packing and mixing operators:
one Arrow pass that returns two small columns.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_PATH = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: How a byte-level vocabulary of this family cuts text before merging; a fixed value that belongs to the file.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@cache
def encoder(path: str = DEFAULT_PATH):
    """The tokenizer of a rank file; special strings in a text are ordinary text."""
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(df: DataFrame, text: str = "text", tokenizer: str = DEFAULT_PATH) -> DataFrame:
    """The other columns of ``df`` and ``tokens``; null and empty text have none."""
    kept = [c for c in df.columns if c != text]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != text)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tool = encoder(tokenizer)
        for batch in batches:
            counts = [len(tool.encode_ordinary(x)) if x else 0 for x in batch[text]]
            yield batch[kept].assign(__tokens=counts)

    return df.select(*kept, F.col(text)).mapInPandas(run, f"{fields}, __tokens long").withColumnRenamed("__tokens", "tokens")

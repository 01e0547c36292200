"""Pictures that a Markdown text refers to.

The files are read from a folder all workers share and are never removed.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions import clean, prompts, rx

Describer = Callable[[bytes], str]
# Fixed value: a picture in Markdown.
_TAG = re.compile(r"!\[(.*?)\]\((.*?)\)")
#: Fixed value: pictures smaller than this on either side are ornaments.
SMALLEST = 50


def picture_size(data: bytes) -> tuple[int, int] | None:
    """Width and height from the header of a PNG, GIF, BMP or JPEG file; None for anything else."""
    if data[:8] == b"\x89PNG\r\n\x1a\n" and len(data) >= 24:
        return struct.unpack(">II", data[16:24])
    if data[:6] in (b"GIF87a", b"GIF89a") and len(data) >= 10:
        return struct.unpack("<HH", data[6:10])
    if data[:2] == b"BM" and len(data) >= 26:
        w, h = struct.unpack("<ii", data[18:26])
        return w, abs(h)
    if data[:2] == b"\xff\xd8":
        at = 2
        while at + 9 < len(data) and data[at] == 0xFF:
            if data[at + 1] in (*range(0xC0, 0xC4), *range(0xC5, 0xC8), *range(0xC9, 0xCC), *range(0xCD, 0xD0)):
                h, w = struct.unpack(">HH", data[at + 5 : at + 9])
                return w, h
            at += 2 + int.from_bytes(data[at + 2 : at + 4], "big")
    return None


FigureDescriber = Callable[[str, bytes], str]


def describe_figures(df: DataFrame, describe: FigureDescriber, text: str = "text", figures: str = "figures") -> DataFrame:
    """``df`` without ``figures``, an ``array<struct<caption string,image binary>>``: the i-th ``<figure>`` of each text is replaced by what the i-th figure shows.

    ``describe`` gets the prompt with the caption and the picture. Where it
    fails a fixed sentence stands for the description. Null figures change
    nothing; tags beyond the figures stay.
    """

    def one(figure: dict) -> dict:
        caption = figure["caption"] or ""
        try:
            said = describe(prompts.FIGURE.format(caption=caption or prompts.NO_CAPTION), bytes(figure["image"]))
        except Exception:  # noqa: BLE001 - one bad figure must not fail the job
            said = prompts.FIGURE_FAILED
        return {"caption": caption, "description": said}

    @F.pandas_udf("array<struct<caption:string,description:string>>")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda fs: None if fs is None else [one(f) for f in fs])

    said = rx.once(df.drop("__said"), "__said", run(F.col(figures)))
    return said.withColumn(text, clean.substitute_figures(F.col(text), F.col("__said"))).drop("__said", figures)


def describe_images(df: DataFrame, folder: str, describe: Describer, text: str = "text") -> DataFrame:
    """Each picture's tag replaced by what it says or shows.

    Addresses and data are left alone, and so are files that are missing, that
    are no picture or whose description fails. Small pictures disappear with
    the line ends around them. A description that begins with ``TEXT_ONLY:`` is
    put in as text, any other as a block under the picture's name. Only texts
    with a tag reach Python; null stays null.
    """

    def one(x: str | None) -> str | None:
        if x is None:
            return None
        for m in reversed(list(_TAG.finditer(x))):
            alt, path = m[1], m[2]
            if path.startswith(("http", "data:")):
                continue
            try:
                with open(os.path.join(folder, path), "rb") as file:
                    data = file.read()
                size = picture_size(data)
                if size is None:
                    continue
                before, after = x[: m.start()], x[m.end() :]
                if min(size) < SMALLEST:
                    x = before.rstrip("\n") + after.lstrip("\n")
                    continue
                said = describe(data)
                if said.startswith("TEXT_ONLY:"):
                    block = f"\n\n{said.replace('TEXT_ONLY:', '').strip()}\n\n"
                else:
                    block = f"\n\n### 図: {alt or os.path.basename(path)}\n{m[0]}\n**説明**: {said}\n\n"
                x = before + block + after
            except Exception:  # noqa: BLE001 - one bad file must not fail the job
                continue
        return x

    @F.pandas_udf(T.StringType())
    def run(s: pd.Series) -> pd.Series:
        return s.map(one)

    has = F.col(text).rlike(r"!\[.*?\]\(.*?\)")
    return df.withColumn(text, F.when(has, run(F.when(has, F.col(text)))).otherwise(F.col(text)))

"""Normalized texts that know where in the source each character comes from, and quotes found through them.

normalize() gives the text and a map of runs: (place in the normalized text, place in the source, length there, length here). A run of equal lengths that is `even` goes
character by character; any other (a ligature that expands, a combining mark that joins, blanks that become one) is one block. Only what changes makes runs.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

#: Characters that are left out: soft hyphen, zero-width space and joiners, word joiner, byte order mark.
UNSEEN = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
#: Signs that are written as one.
SIGNS = {c: "-" for c in "\u2010\u2011\u2012\u2013\u2014\u2212"} | {c: "'" for c in "\u2018\u2019\u201b"} | {c: '"' for c in "\u201c\u201d\u201e\u201f"}
#: What may change: blanks other than one space between seen characters, unseen characters, characters with marks, all beyond ASCII.
_CLUSTER = re.compile(rf"(?=[\s{UNSEEN}]{{2}}|[^\S\x20])[\s{UNSEEN}]*\s[\s{UNSEEN}]*|[{UNSEEN}]+|[^\x00-\x7f][\u0300-\u036f]*|[\x21-\x7e][\u0300-\u036f]+")


def _form(cluster: str) -> str:
    if cluster.strip(UNSEEN).isspace():
        return " "
    return re.sub(r"\s+", " ", "".join(SIGNS.get(c, c) for c in unicodedata.normalize("NFKC", cluster) if c not in UNSEEN))


def normalize(text: str) -> tuple[str, list[tuple[int, int, int, int, bool]]]:
    """NFKC of each character with its marks, unseen characters left out, dashes and quotes unified, runs of blanks as one blank; and the map of its runs."""
    out: list[str] = []
    runs: list[tuple[int, int, int, int, bool]] = []
    size = at = 0

    def put(new: str, a: int, z: int, even: bool) -> None:
        nonlocal size
        if new:
            out.append(new)
            runs.append((size, a, z - a, len(new), even))
            size += len(new)

    for m in _CLUSTER.finditer(text):
        new = _form(m[0])
        if new == m[0]:
            continue
        put(text[at : m.start()], at, m.start(), True)
        at = m.end()
        put(new[1:] if new[:1] == " " and out and out[-1][-1] == " " else new, m.start(), at, False)
    put(text[at:], at, len(text), True)
    return "".join(out), runs


def source_span(runs: list[tuple[int, int, int, int, bool]], start: int, end: int) -> tuple[int, int]:
    """The span of the source from which the normalized characters start to end (exclusive, not empty) come."""
    starts = [r[0] for r in runs]
    first, last = runs[bisect_right(starts, start) - 1], runs[bisect_right(starts, end - 1) - 1]
    a = first[1] + (start - first[0]) if first[4] else first[1]
    z = last[1] + (end - last[0]) if last[4] else last[1] + last[2]
    return a, z


@lru_cache(maxsize=8)
def _normal(text: str):
    return normalize(text)


def places(text: str, quote: str, least: int = 1) -> tuple[int | None, int | None, int]:
    """(start, end) in the source of a quote's only place, and its number of places, counted up to two; a quote of under `least` characters has none."""
    norm, runs = _normal(text)
    want = normalize(quote)[0].strip()
    if len(want) < max(least, 1):
        return None, None, 0
    at = norm.find(want)
    if at < 0:
        return None, None, 0
    if norm.find(want, at + 1) >= 0:
        return None, None, 2
    return *source_span(runs, at, at + len(want)), 1


@F.pandas_udf(StructType([StructField(c, IntegerType()) for c in ("start", "end", "n_places")]))
def _located(text: pd.Series, quote: pd.Series, least: pd.Series) -> pd.DataFrame:
    found = [places(t, q, n) if isinstance(t, str) and isinstance(q, str) else (None, None, 0) for t, q, n in zip(text, quote, least, strict=True)]
    return pd.DataFrame(found, columns=["start", "end", "n_places"]).astype({"start": "Int32", "end": "Int32"})


def located(text: Column, quote: Column, least: int = 8) -> Column:
    """struct(start, end, n_places): where a quote stands in the source, in code points. Null unless it stands in one place; n_places is 0, 1, or 2 for several.

    Rows of one text should follow each other: a text is normalized once for those. Nulls have no place.
    """
    return _located(text, quote, F.lit(least))


@F.pandas_udf(StringType())
def normal_text(text: pd.Series) -> pd.Series:
    return text.map(lambda t: normalize(t)[0] if isinstance(t, str) else None)

"""Scalar functions that Spark lacks, as Arrow-batched UDFs: Unicode normal forms, keyed pseudonyms, text similarity."""

from __future__ import annotations

import difflib
import hashlib
import hmac
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def normal_form(text: Column, form: str = "NFKC") -> Column:
    """The Unicode normal form of a text; null stays null."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: unicodedata.normalize(form, x), na_action="ignore")

    return run(text)


def without_marks(text: Column) -> Column:
    """Upper case without combining marks."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: "".join(c for c in unicodedata.normalize("NFKD", x.upper()) if not unicodedata.combining(c)), na_action="ignore")

    return run(text)


def casefolded(text: Column) -> Column:
    """Lower case with sharp s as ss: case-insensitive equality without a UDF."""
    return F.replace(F.lower(text), F.lit("ß"), F.lit("ss"))


def pseudonym(value: Column, secret: str, domain: str = "", length: int = 16) -> Column:
    """The first hexadecimal digits of HMAC-SHA256(secret, domain | value); null stays null."""
    key, prefix = secret.encode(), f"{domain}|".encode()

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: hmac.new(key, prefix + str(x).encode(), hashlib.sha256).hexdigest()[:length], na_action="ignore")

    return run(value)


def similarity(left: Column, right: Column) -> Column:
    """Ratio of matching blocks of two texts, 0 to 1 (1 if one holds the other)."""

    @F.pandas_udf("double")
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        def one(x, y):
            if x is None or y is None:
                return None
            return 1.0 if x in y or y in x else difflib.SequenceMatcher(None, x, y, autojunk=False).ratio()

        return pd.Series([one(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")

    return run(left, right)


def heading_key(text: Column) -> Column:
    """A heading for look-up: normal form, one kind of dash and quote, no soft hyphens, no date at the end, upper case."""
    t = normal_form(text)
    t = F.translate(t, "‐‑‒–—−„“”‚‘’­", "------\"\"\"'''")
    t = F.regexp_replace(t, r"[ ,:]*(vom|from|am)?[ ]*\d{1,2}\.\d{1,2}\.\d{2,4}[ :]*$", "")
    return F.upper(F.trim(F.regexp_replace(F.regexp_replace(t, r"\s+", " "), r"\s*:\s*$", "")))

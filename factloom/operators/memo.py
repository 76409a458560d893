"""Externally supplied logic: a pluggable text function, memoized by the hash of its request, validated, with one bounded retry.

The operators fix everything around the function: each distinct request is answered once, answers are kept in a table, invalid ones are asked again with
the error appended, and what stays invalid becomes a flagged row instead of a guess.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def request_key(domain: str, request: Column) -> Column:
    return F.sha2(F.concat(F.lit(f"{domain}|"), request), 256)


def answered(rows: DataFrame, request: str, domain: str, cache: DataFrame, answer: Callable[[pd.Series], pd.Series], valid: Callable[[Column], Column], retries: int = 1) -> tuple[DataFrame, DataFrame]:
    """rows with answer, valid; and the new cache rows (key, answer, valid) to append. cache has key, answer, valid.

    answer: vectorised function of request texts, run on executors in Arrow batches, for distinct requests that the cache lacks only.
    """
    from factloom.sources.work import written

    ask = F.pandas_udf(answer, "string")
    keyed = rows.withColumn("key", request_key(domain, F.col(request)))
    known = cache.where("valid").select("key", "answer", "valid").dropDuplicates(["key"])
    todo = keyed.select("key", request).dropDuplicates(["key"]).join(known, "key", "left_anti")
    fresh = written(todo.withColumn("answer", ask(F.col(request))).withColumn("valid", F.coalesce(valid(F.col("answer")), F.lit(False))), "answers")
    for _ in range(retries):
        bad = fresh.where(~F.col("valid"))
        again = bad.withColumn("answer", ask(F.concat(F.col(request), F.lit("\nThe last answer was not valid: "), F.coalesce("answer", F.lit("")))))
        fresh = written(fresh.where("valid").unionByName(again.withColumn("valid", F.coalesce(valid(F.col("answer")), F.lit(False)))), "answers")
    new = fresh.select("key", "answer", "valid")
    return keyed.join(known.unionByName(new), "key", "left").drop("key"), new


def echo_stub(texts: pd.Series) -> pd.Series:
    """A deterministic stand-in for a model: the request's first 20 characters as JSON."""
    import json

    return texts.map(lambda t: json.dumps({"echo": t[:20]}), na_action="ignore")


def split_valid(rows: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that keep all rules, and the others with the names of the broken ones; an unknown rule is broken."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), name) for name, ok in rules.items()]))
    marked = rows.withColumn("broken", broken)
    return marked.where(F.size("broken") == 0).drop("broken"), marked.where(F.size("broken") > 0)


def grounded(rows: DataFrame, quote: str, source: str, fields: list[str]) -> DataFrame:
    """rows whose fields are null, and `flag` set, unless the quote is in the source text (blanks aside)."""
    from factloom.operators.text import normalized

    found = F.contains(normalized(F.col(source)), normalized(F.col(quote))) & (F.length(F.trim(quote)) > 0)
    ok = F.coalesce(found, F.lit(False))
    return rows.withColumns({c: F.when(ok, F.col(c)) for c in fields}).withColumn("flag", F.when(~ok, "no_evidence"))

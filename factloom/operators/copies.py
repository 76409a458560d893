"""Copies by edit ratio: texts of a key whose matching ratio (2 x matched characters / characters of both) is high enough, found without making all pairs.

A pair of ratio t or more matches m >= t (|a| + |b|) / 2 characters in at most |a| + |b| - 2 m + 1 blocks, and a block of k characters has k - q + 1 of its q-grams on both
sides. So such a pair shares a known number of numbered q-grams (the first `th`, the second `th`, ...), and of any order of all q-grams one of the first few of each
text. Rare ones come first in that order. Matched blocks stand in one order on both sides, so the other characters, |a| + |b| - 2 m, are at least the edit distance: pairs that
meet are held against it where they meet, before they are gathered. What is left is counted in full against the same bound, then the exact ratio decides. Texts so short that
there is no bound (a few characters) meet the different texts of their key and length.
"""

from __future__ import annotations

from collections import Counter
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from factloom.operators import identity


@F.pandas_udf(DoubleType())
def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Matching ratio of the lesser text to the greater one (the ratio isn't symmetric); null with a null."""

    def one(x, y):
        if not isinstance(x, str) or not isinstance(y, str):
            return None
        return SequenceMatcher(None, min(x, y), max(x, y), autojunk=False).ratio()

    return pd.Series([one(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


def _shared(n, m, least: tuple[int, int], q: int):
    """2 x least[1] times the least number of numbered q-grams that texts of n and m characters of enough ratio share; zero or less: no bound. Grows with m."""
    return (n + m) * (least[0] - 2 * (q - 1) * (least[1] - least[0])) - 2 * least[1] * (q - 1)


def ratio_from(least: tuple[int, int], q: int):
    """ratio() of two texts where it is `least` or more, else null: pairs that share too few numbered q-grams, or characters, are not compared."""
    t = least[0] / least[1]

    def one(x: str, y: str) -> float | None:
        x, y = min(x, y), max(x, y)
        grams = lambda s: Counter(s[i : i + q] for i in range(len(s) - q + 1))
        if 2 * least[1] * (grams(x) & grams(y)).total() < _shared(len(x), len(y), least, q):
            return None
        pair = SequenceMatcher(None, x, y, autojunk=False)
        got = pair.ratio() if pair.quick_ratio() >= t else 0.0
        return got if got >= t else None

    def many(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([one(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")

    many.__annotations__ = {"a": pd.Series, "b": pd.Series, "return": pd.Series}
    return F.pandas_udf(many, DoubleType())


def near_copies(rows: DataFrame, keys: list[str], text: str, *, least: tuple[int, int] = (85, 100), q: int = 2) -> DataFrame:
    """keys, a, b, ratio: the pairs of different texts a < b of a key whose ratio is `least` (numerator, denominator) or more. Null keys, null and empty texts have no pair."""
    texts = rows.where(F.length(text) > 0).select(*keys, F.col(text).alias("__t")).distinct().withColumn("__n", F.length("__t"))
    # numbered q-grams: (gram, how often it has stood in the text before)
    places = F.transform(F.sequence(F.lit(1), F.greatest(F.col("__n") - q + 1, F.lit(1))), lambda i: F.substr("__t", i, F.lit(q)))
    grams = texts.select(*keys, "__t", "__n", F.posexplode(places).alias("__i", "__g")).where(F.length("__g") == q)
    grams = grams.withColumn("__k", F.row_number().over(Window.partitionBy(*keys, "__t", "__g").orderBy("__i"))).drop("__i")
    often = grams.groupBy(*keys, "__g", "__k").agg(F.count(F.lit(1)).alias("__f"))
    ranked = grams.join(often, [*keys, "__g", "__k"])
    ranked = ranked.withColumn("__r", F.row_number().over(Window.partitionBy(*keys, "__t").orderBy("__f", "__g", "__k")))
    t = least[0] / least[1]
    # the shortest partner that can be close enough needs the fewest shared q-grams
    shortest = F.ceil(F.col("__n") * F.lit(least[0]) / F.lit(2 * least[1] - least[0]))
    needed = F.ceil(_shared(F.col("__n"), shortest, least, q) / F.lit(2 * least[1]))
    prefix = ranked.where((needed > 0) & (F.col("__r") <= F.col("__n") - q + 1 - needed + 1)).select(*keys, "__t", "__n", "__g", "__k")
    other = prefix.select(*keys, F.col("__t").alias("__u"), F.col("__n").alias("__m"), "__g", "__k")
    most = F.floor((F.col("__n") + F.col("__m")) * F.lit(least[1] - least[0]) / F.lit(least[1])).cast("int")
    close = (2 * F.least("__n", "__m") >= t * (F.col("__n") + F.col("__m"))) & (F.call_function("levenshtein", F.col("__t"), F.col("__u"), most) >= 0)
    # few rows may make many pairs: the rows are dealt to all partitions, whatever their size
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = lambda df: df.repartition(parts, *keys, "__g", "__k")
    met = dealt(prefix).join(dealt(other), [*keys, "__g", "__k"]).where((F.col("__t") < F.col("__u")) & close).select(*keys, "__t", "__n", "__u", "__m").distinct()
    # a text without a bound meets all of its key that are about as short
    short = texts.where((needed <= 0) | (F.col("__n") < q))
    unbound = short.select(*keys, "__t", "__n").join(texts.select(*keys, F.col("__t").alias("__u"), F.col("__n").alias("__m")), keys).where((F.col("__t") != F.col("__u")) & close)
    unbound = unbound.select(*keys, F.least("__t", "__u").alias("__t"), F.greatest("__t", "__u").alias("__u"))
    pairs = met.select(*keys, "__t", "__u").unionByName(unbound).distinct()
    return pairs.withColumn("ratio", ratio_from(least, q)("__t", "__u")).where("ratio IS NOT NULL").select(*keys, F.col("__t").alias("a"), F.col("__u").alias("b"), "ratio")


def copy_groups(rows: DataFrame, keys: list[str], row_id: str, text: str, *, least: tuple[int, int] = (85, 100), least_characters: int = 0, q: int = 2) -> DataFrame:
    """keys, row_id, leader, n_links: rows of a key whose texts are linked by near_copies, or equal, form a group led by its smallest id; n_links counts the
    different texts a row's text is linked with. Texts under least_characters are only grouped when equal; rows with a null key or a null or empty text stand alone."""
    found = near_copies(rows.where(F.length(text) >= least_characters), keys, text, least=least, q=q)
    firsts = rows.where(F.length(text) > 0).groupBy(*keys, text).agg(F.min(row_id).alias("__id"))
    first = lambda c, out: firsts.select(*keys, F.col(text).alias(c), F.col("__id").alias(out))
    edges = found.join(first("a", "__x"), [*keys, "a"]).join(first("b", "__y"), [*keys, "b"]).select("__x", "__y")
    links = edges.select(F.col("__x").alias("__id")).unionByName(edges.select(F.col("__y").alias("__id"))).groupBy("__id").agg(F.count(F.lit(1)).alias("n_links"))
    led = firsts.join(identity.components(edges, "__x", "__y").withColumnRenamed("id", "__id"), "__id", "left").join(links, "__id", "left")
    led = led.select(*keys, text, F.coalesce("component", "__id").alias("leader"), F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"))
    out = rows.select(*keys, row_id, text).join(led, [*keys, text], "left")
    return out.select(*keys, row_id, F.coalesce("leader", row_id).alias("leader"), F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"))

"""Ranks and exact quantiles of groups of any size.

A window over a group sorts it in one task. Here rows are dealt to ranges of (group, value), running sums are taken inside a range, and the totals of the
ranges before it (a row for each group in each range) are added. A group that holds most rows is so spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.sources.work import written


def running_totals(df: DataFrame, keys: list[str], order: list[Column], amount: str, out: str) -> DataFrame:
    """df with `out`: the sum of `amount` over the rows of the same keys that come before in order (which must be total)."""
    ranged = written(df.repartitionByRange(*[F.col(k) for k in keys], *order).withColumn("__range", F.spark_partition_id()), "ranged")
    per = ranged.groupBy(*keys, "__range").agg(F.sum(amount).alias("__n"))
    # one row for each group in each range
    w = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("__range").alias("__r"), F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__before"))
    same = F.col("__range") == F.col("__r")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    inside = Window.partitionBy(*keys, "__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    own = ranged.withColumn("__own", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    return own.join(offsets, same).select(*df.columns, (F.col("__own") + F.col("__before")).cast("bigint").alias(out))


def row_numbers(df: DataFrame, keys: list[str], order: list[Column], out: str) -> DataFrame:
    """df with `out`: 1, 2, ... inside each group, in order."""
    got = running_totals(df.withColumn("__one", F.lit(1)), keys, order, "__one", out)
    return got.drop("__one").withColumn(out, (F.col(out) + 1).cast("int"))


def counted_values(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, value, t, before: how often each known value occurs, and how many smaller ones its group has."""
    per = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("t"))
    return running_totals(per, keys, [F.col(value)], "t", "before")


#: Accuracy of the approximate quantiles that bracket the exact ones, and how many values inside a group's brackets one task may sort.
ACCURACY, SORTED = 10_000, 1_000_000


def _bracketed(df: DataFrame, keys: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """keys, value, t, before: as counted_values, for the values around the quantiles only, and __total.

    Approximate quantiles, whose ranks are off by a known share, bracket each exact one. A second scan counts the values under each bracket and keeps those inside.
    """
    known = df.where(F.col(value).isNotNull()).select(*keys, value)
    # the error of an approximate rank, the one rank that interpolation needs, and one to spare: in groups under ACCURACY values the bracket is the whole group
    bound = 3 / ACCURACY
    asked = [x for s in shares.values() for x in (max(s - bound, 0.0), min(s + bound, 1.0))]
    about = known.groupBy(*keys).agg(F.percentile_approx(value, F.array(*[F.lit(x) for x in asked]), ACCURACY).alias("__q"), F.count(F.lit(1)).alias("__total"), F.min(value).alias("__least"), F.max(value).alias("__most"))
    whole = F.col("__total") <= ACCURACY
    ends = [
        (F.when(whole | F.lit(s - bound <= 0), F.col("__least")).otherwise(F.get("__q", F.lit(2 * i))), F.when(whole | F.lit(s + bound >= 1), F.col("__most")).otherwise(F.get("__q", F.lit(2 * i + 1))))
        for i, s in enumerate(shares.values())
    ]
    about = written(about.select(*[F.col(k).alias(f"__{k}") for k in keys], "__total", F.array(*[F.struct(a.alias("a"), z.alias("z")) for a, z in ends]).alias("__ends")), "brackets")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    rows = known.join(about, same)
    # values outside all brackets become one row for each stretch between brackets: their number is all that matters
    inside = F.exists("__ends", lambda e: (F.col(value) >= e["a"]) & (F.col(value) <= e["z"]))
    under = F.aggregate("__ends", F.lit(0), lambda s, e: s + (F.col(value) > e["z"]).cast("int"))
    kept = rows.select(*keys, "__total", under.alias("__stretch"), F.when(inside, F.col(value)).alias(value))
    counted = written(kept.groupBy(*keys, "__total", "__stretch", value).agg(F.count(F.lit(1)).alias("t")), "counted")
    # in a stretch the outside values come before those inside the bracket that ends it
    order = [F.col("__stretch").asc(), F.col(value).asc_nulls_first()]
    most = counted.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    if most <= SORTED:
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return counted.withColumn("before", F.coalesce(F.sum("t").over(w), F.lit(0)))
    return running_totals(counted, keys, order, "t", "before")


def quantiles(df: DataFrame, keys: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """keys and a column for each named share: exact quantiles with linear interpolation, rounded to four places. Groups without a known value have no row.

    Two scans, no sort of the values: only what lies between approximate quantiles around each exact one is counted value by value."""
    rows, parts = _bracketed(df, keys, value, shares), []
    for name, share in shares.items():
        at = (F.col("__total") - 1) * F.lit(share)
        for side, place in (("low", F.floor(at)), ("high", F.ceil(at))):
            parts.append(F.max(F.when((F.col("before") <= place) & (place < F.col("before") + F.col("t")), F.col(value).cast("double"))).alias(f"__{name}_{side}"))
    got = rows.groupBy(*keys).agg(*parts, F.max("__total").alias("__total"))
    between = lambda n, s: F.col(f"__{n}_low") + (F.col(f"__{n}_high") - F.col(f"__{n}_low")) * ((F.col("__total") - 1) * F.lit(s) - F.floor((F.col("__total") - 1) * F.lit(s)))
    return got.select(*keys, *[F.round(between(n, s), 4).alias(n) for n, s in shares.items()])

"""Scores whose unknown items give bounds instead of zeros; decision tables; criteria; violation counters; coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def score_with_bounds(items: dict[str, tuple[Column, int]]) -> list[Column]:
    """score_min, score_max, score (null unless they agree), n_unknown of weighted boolean items; null items are unknown."""
    low = high = unknown = F.lit(0)
    for item, weight in items.values():
        points = F.when(item, weight).otherwise(0)
        low = low + F.when(item.isNull(), min(weight, 0)).otherwise(points)
        high = high + F.when(item.isNull(), max(weight, 0)).otherwise(points)
        unknown = unknown + item.isNull().cast("int")
    return [low.alias("score_min"), high.alias("score_max"), F.when(low == high, low).alias("score"), unknown.alias("n_unknown")]


def bounded_class(low: Column, high: Column, limits: list[tuple[str, float]]) -> Column:
    """The class (name, upper limit inclusive; the last for the rest) if both bounds fall into one, else null."""
    of = lambda x: _first_class(x, limits)
    return F.when(of(low) == of(high), of(low))


def _first_class(x: Column, limits: list[tuple[str, float]]) -> Column:
    out = None
    for name, limit in limits[:-1]:
        out = F.when(x <= limit, name) if out is None else out.when(x <= limit, name)
    return F.lit(limits[-1][0]) if out is None else F.when(x.isNull(), None).otherwise(out.otherwise(limits[-1][0]))


def decide(rules: list[tuple[str, Column]], default: str | None = None) -> Column:
    """The first rule whose predicate is true; a predicate that is unknown before that makes the result null."""
    out = F.lit(default)
    for name, predicate in reversed(rules):
        out = F.when(predicate.isNull(), F.lit(None).cast("string")).when(predicate, name).otherwise(out)
    return out


def criteria(held: dict[str, Column]) -> list[Column]:
    """met, failed, unknown: comma-joined names of criteria by their state."""
    part = lambda test: F.array_join(F.array_compact(F.array(*[F.when(test(c), name) for name, c in held.items()])), ",")
    return [part(lambda c: c).alias("met"), part(lambda c: ~c).alias("failed"), part(lambda c: c.isNull()).alias("unknown")]


def violations(gates: dict[str, DataFrame]) -> DataFrame:
    """gate, n_violations for each named table of offending rows; the tables are counted where they are."""
    out = None
    for name, rows in gates.items():
        n = rows.agg(F.count(F.lit(1)).alias("n_violations")).select(F.lit(name).alias("gate"), "n_violations")
        out = n if out is None else out.unionByName(n)
    return out


def assert_no_violations(counts: DataFrame) -> None:
    bad = counts.where("n_violations > 0").collect()
    if bad:
        raise AssertionError("; ".join(f"{r['gate']}: {r['n_violations']}" for r in bad))


def greedy_cover(items: DataFrame, item: str, feature: str, k: int) -> DataFrame:
    """rank, item: k picks, each the item with the most features not yet covered, weighted by their rarity; ties go to the smaller item.

    k is a stated, small number; each round is one aggregation over what is still uncovered, and only the pick reaches the driver.
    """
    spark = items.sparkSession
    rows = items.select(item, feature).distinct()
    weight = rows.groupBy(feature).agg((1 / F.sqrt(F.count(F.lit(1)))).alias("__w"))
    from factloom.sources.work import written

    open_, picks = written(rows.join(weight, feature), "open"), []
    for _ in range(k):
        best = open_.groupBy(item).agg(F.round(F.sum("__w"), 9).alias("__s")).orderBy(F.col("__s").desc(), item).limit(1).first()
        if best is None:
            break
        picks.append((len(picks) + 1, best[0]))
        covered = rows.where(F.col(item) == best[0]).select(feature)
        open_ = written(open_.join(covered, feature, "left_anti"), "open")  # earlier rounds aren't computed again
    kind = dict(items.dtypes)[item]
    return spark.createDataFrame(picks, f"rank int, {item} {kind}")


def checksum11(digits: Column, weights: list[int], check_at: int) -> Column:
    """Whether the digit at check_at (from 1) is the weighted sum of the digits modulo 11; the weight there is 0."""
    total = F.lit(0)
    for i, w in enumerate(weights, 1):
        total = total + F.substring(digits, i, 1).try_cast("int") * w
    return F.when(digits.rlike(rf"^[0-9]{{{len(weights)}}}$"), total % 11 == F.substring(digits, check_at, 1).try_cast("int")).otherwise(False)

"""Grouping sets with exact and sketched measures in one pass, and sketches that are stored and merged."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Two standard errors of a distinct count with lg_k = 12, and the rank error of a quantile sketch with k = 200, as shares.
DISTINCT_ERROR, RANK_ERROR = 2 * 1.04 / 64, 0.0133
LG_K, QUANTILE_K = 12, 200


def all_sets(columns: list[str]) -> list[list[str]]:
    return [list(s) for n in range(len(columns), -1, -1) for s in combinations(columns, n)]


def rollup_sets(columns: list[str]) -> list[list[str]]:
    return [columns[:n] for n in range(len(columns), -1, -1)]


def grouped(df: DataFrame, columns: list[str], sets: list[list[str]], measures: dict[str, Column]) -> DataFrame:
    """columns, grouping_id and the measures for each set of grouping columns (any sets: cube, rollup or a choice), in one aggregation.

    grouping_id has a bit for each column, the first the highest, set where the column isn't grouped by: it tells such a row's null from a null value.
    """
    chosen = [[F.col(c) for c in s] for s in sets]
    return df.groupingSets(chosen, *[F.col(c) for c in columns]).agg(F.grouping_id().alias("grouping_id"), *[m.alias(n) for n, m in measures.items()])


def sketches(df: DataFrame, keys: list[str], distinct: str | None = None, value: str | None = None) -> DataFrame:
    """keys, n, distinct_sketch (HyperLogLog of `distinct`), value_sketch (KLL of `value`): a few kilobytes a group, to be stored and merged later. Nulls don't count."""
    parts = [F.count(F.lit(1)).alias("n")]
    if distinct is not None:
        parts.append(F.hll_sketch_agg(distinct, LG_K).alias("distinct_sketch"))
    if value is not None:
        parts.append(F.kll_sketch_agg_double(F.col(value).cast("double"), QUANTILE_K).alias("value_sketch"))
    return df.groupBy(*keys).agg(*parts)


def merged(stored: DataFrame, keys: list[str]) -> DataFrame:
    """Sketches of finer groups as sketches of `keys`, whatever the partitions were: n, distinct_sketch, value_sketch (those that are there)."""
    parts = [F.sum("n").alias("n")]
    if "distinct_sketch" in stored.columns:
        parts.append(F.hll_union_agg("distinct_sketch").alias("distinct_sketch"))
    if "value_sketch" in stored.columns:
        parts.append(F.kll_merge_agg_double("value_sketch").alias("value_sketch"))
    return stored.groupBy(*keys).agg(*parts)


def estimates(stored: DataFrame, keys: list[str], shares: dict[str, float]) -> DataFrame:
    """keys, n, n_distinct (about, see DISTINCT_ERROR) and the named quantiles (their ranks within RANK_ERROR) of stored sketches."""
    out = [F.col("n")]
    if "distinct_sketch" in stored.columns:
        out.append(F.hll_sketch_estimate("distinct_sketch").alias("n_distinct"))
    if "value_sketch" in stored.columns:
        out += [F.kll_sketch_get_quantile_double("value_sketch", F.lit(s)).alias(name) for name, s in shares.items()]
    return stored.select(*keys, *out)

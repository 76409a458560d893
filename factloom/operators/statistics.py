"""Descriptive statistics with unknown kept apart from false.

All functions take DataFrames and column names, group by keys with partial aggregation, and never turn null into false.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.operators import ranks


def consensus(value: str | Column) -> Column:
    """Aggregate: the value if all non-null ones agree, else null."""
    value = F.col(value) if isinstance(value, str) else value
    return F.when(F.min(value) == F.max(value), F.min(value))


def conflict(value: str | Column) -> Column:
    """Aggregate: whether non-null values disagree."""
    value = F.col(value) if isinstance(value, str) else value
    return F.coalesce(F.min(value) != F.max(value), F.lit(False))


def assessed_any(value: str | Column, positive, negative) -> Column:
    """Aggregate: true if any value is positive, false if all are negative, else null."""
    value = F.col(value) if isinstance(value, str) else value
    return F.when(F.bool_or(value.eqNullSafe(F.lit(positive))), F.lit(True)).when(F.bool_and(value.eqNullSafe(F.lit(negative))), F.lit(False))


def known_any(flag: str | Column) -> Column:
    """Aggregate: true if any flag is true, else null; a negative excludes nothing."""
    flag = F.col(flag) if isinstance(flag, str) else flag
    return F.when(F.bool_or(flag), F.lit(True))


def best(values: Column, priority: list, default=None) -> Column:
    """The first of `priority` that is among an array's values."""
    hit = F.filter(F.array(*[F.lit(p) for p in priority]), lambda p: F.array_contains(values, p))
    return F.coalesce(F.get(hit, F.lit(0)), F.lit(default))


def strongest(status: str, ranks: dict[str, int]) -> Column:
    """Aggregate: the status of the highest rank."""
    rank = F.create_map(*[F.lit(x) for pair in ranks.items() for x in pair])
    return F.max_by(F.col(status), rank[F.col(status)])


def status_by_precedence(rules: list[tuple[str, Column]], default: str) -> Column:
    """Aggregate: the first status whose row predicate holds for any row of the group."""
    out = None
    for name, predicate in rules:
        hit = F.bool_or(F.coalesce(predicate, F.lit(False)))
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise(default)


def strongest_of_best_tier(df: DataFrame, keys: list[str], tier: str, status: str, ranks: dict[str, int]) -> DataFrame:
    """Per key: only rows of the lowest tier number count; of those the strongest status. One aggregation, no window.

    Struct order does it: the maximum of (-tier, rank) is the strongest status of the lowest tier.
    """
    rank = F.create_map(*[F.lit(x) for pair in ranks.items() for x in pair])[F.col(status)]
    return df.groupBy(*keys).agg(F.min(tier).alias(tier), F.max_by(status, F.struct((-F.col(tier)).alias("t"), rank.alias("r"))).alias(status))


_QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def continuous(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, n, n_missing and exact quartiles with linear interpolation; a group without a known value has null quartiles."""
    counts = df.groupBy(*keys).agg(F.count(value).alias("n"), (F.count(F.lit(1)) - F.count(value)).alias("n_missing"))
    return _joined(counts, ranks.quantiles(df, keys, value, _QUARTILES), keys)


def _joined(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """left with the other columns of right, by keys of which null is a value."""
    right = right.select(*[F.col(k).alias(f"__{k}") for k in keys], *[c for c in right.columns if c not in keys])
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return left.join(right, same, "left").drop(*[f"__{k}" for k in keys])


def categorical(flag: str | Column, name: str) -> list[Column]:
    """Aggregates: how many are true of the known ones, and the share in per cent (null if none is known)."""
    flag = F.col(flag) if isinstance(flag, str) else flag
    k, n = F.count_if(flag), F.count(flag)
    return [k.alias(f"{name}_k"), n.alias(f"{name}_n"), F.when(n > 0, F.round(k * 100.0 / n, 4)).alias(f"{name}_pct")]


def share_text(k: Column, n: Column) -> Column:
    """`k/n (p%)`, with one decimal."""
    return F.when(n > 0, F.concat(k.cast("string"), F.lit("/"), n.cast("string"), F.lit(" ("), F.format_string("%.1f", k * 100.0 / n), F.lit("%)")))


def p_text(p: Column) -> Column:
    """`<0.001`, else three decimals; null stays null."""
    return F.when(p < 0.001, "<0.001").otherwise(F.format_string("%.3f", p))


def missing(df: DataFrame, columns: list[str]) -> DataFrame:
    """variable, n_known, n_missing of each column, in one pass."""
    counts = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count(c).alias(c) for c in columns])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).alias("n_known"), (F.col("__n") - F.col(c)).alias("n_missing")) for c in columns]))
    return counts.select(rows.alias("r")).select("r.*")


def one_hot(df: DataFrame, column: str, values: list, prefix: str) -> DataFrame:
    """df with a boolean column for each value; null where the value is unknown."""
    return df.withColumns({f"{prefix}{v}": F.col(column) == F.lit(v) for v in values})


def long_counts(df: DataFrame, counters: dict[str, Column]) -> DataFrame:
    """measure, k, n: one row for each named predicate, from one aggregation; unknown predicates count in neither."""
    got = df.agg(*[x for name, p in counters.items() for x in (F.count_if(p).alias(f"{name}__k"), F.count(p).alias(f"{name}__n"))])
    rows = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(f"{m}__k").alias("k"), F.col(f"{m}__n").alias("n")) for m in counters]))
    return got.select(rows.alias("r")).select("r.*")


def densified(groups: DataFrame, expected: DataFrame, keys: list[str], zeros: list[str]) -> DataFrame:
    """Every expected key, with empty groups where none was found; `zeros` are counts of 0 there."""
    return expected.select(*keys).distinct().join(groups, keys, "left").na.fill(0, zeros)


def grid(df: DataFrame, key: str, column: str, most: int = 10_000) -> DataFrame:
    """Every distinct key with every distinct value of column, which is a short list: more than `most` values are an error. Their number is checked first."""
    values = [r[0] for r in df.select(column).where(F.col(column).isNotNull()).distinct().limit(most + 1).collect()]
    if len(values) > most:
        raise ValueError(f"{column} has more than {most} values")
    expected = F.array(*[F.lit(v) for v in sorted(values)]) if values else F.array().cast(f"array<{dict(df.dtypes)[column]}>")
    return df.select(key).distinct().select(key, F.explode(expected).alias(column))


def pivot_counts(df: DataFrame, key: str, column: str, values: list[str]) -> DataFrame:
    """A count column for each of the stated values (so no pass over the data to find them), and the rest in `other`."""
    known = F.col(column).isin(values)
    return df.groupBy(key).agg(*[F.count_if(F.col(column) == v).alias(f"n_{v}") for v in values], F.count_if(~F.coalesce(known, F.lit(False))).alias("other"))


def mann_whitney(df: DataFrame, stratum: list[str], value: str, flag: str) -> DataFrame:
    """U of the flagged group, n1, n0, z (tie and continuity corrected), for each stratum.

    Values are counted first, and ranks come from the counts of smaller values (ranks.running_totals), so no stratum is gathered in one task.
    """
    per = df.where(F.col(value).isNotNull() & F.col(flag).isNotNull()).groupBy(*stratum, value).agg(F.count_if(F.col(flag)).alias("t1"), F.count(F.lit(1)).alias("t"))
    ranked = ranks.running_totals(per, stratum, [F.col(value)], "t", "before").withColumn("rank", F.col("before") + (F.col("t") + 1) / 2)
    out = ranked.groupBy(*stratum).agg(F.sum(F.col("rank") * F.col("t1")).alias("r1"), F.sum("t1").alias("n1"), F.sum("t").alias("n"), F.sum(F.col("t").cast("double") * (F.col("t") * F.col("t") - 1)).alias("ties"))
    out = out.withColumn("n0", F.col("n") - F.col("n1")).withColumn("u", F.col("r1") - F.col("n1") * (F.col("n1") + 1) / 2)
    n = F.col("n").cast("double")
    variance = F.col("n1") * F.col("n0") / 12.0 * ((n + 1) - F.col("ties") / (n * F.greatest(n - 1, F.lit(1.0))))
    mean = F.col("n1") * F.col("n0") / 2.0
    z = F.when((F.col("n1") > 0) & (F.col("n0") > 0) & (variance > 0), F.greatest(F.abs(F.col("u") - mean) - 0.5, F.lit(0.0)) / F.sqrt(variance))
    return out.select(*stratum, "n1", "n0", F.round("u", 4).alias("u"), F.round(z, 6).alias("z"))


def fisher_exact(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Two-sided p of the table [[a, b], [c, d]]: the sum over tables as likely as it or less. Null if a margin is 0.

    The possible tables are walked once by the ratio of neighbouring probabilities, so cost grows with the smallest margin only.
    """
    r1, c1, n = a + b, a + c, a + b + c + d
    low, high = F.greatest(F.lit(0).cast("bigint"), r1 + c1 - n), F.least(r1, c1)
    step = lambda x: F.log((r1 - x) * (c1 - x) * F.lit(1.0)) - F.log((x + 1) * (n - r1 - c1 + x + 1) * F.lit(1.0))
    # log-probabilities relative to the lowest table, as a running sum over the tables
    logs = F.aggregate(F.sequence(low, high), F.array(F.lit(0.0)), lambda s, x: F.when(x < high, F.concat(s, F.array(F.element_at(s, -1) + step(x)))).otherwise(s))
    def p(ls: Column) -> Column:
        top, own = F.array_max(ls), F.get(ls, (a - low).cast("int"))
        total = F.aggregate(ls, F.lit(0.0), lambda s, x: s + F.exp(x - top))
        tail = F.aggregate(ls, F.lit(0.0), lambda s, x: s + F.when(x <= own + 1e-7, F.exp(x - top)).otherwise(0.0))
        return F.least(F.lit(1.0), tail / total)
    value = F.transform(F.array(logs), p)[0]
    return F.when((r1 > 0) & (c1 > 0) & (c + d > 0) & (b + d > 0), value)


def baseline_table(df: DataFrame, group: str, numeric: list[str], flags: list[str]) -> DataFrame:
    """variable, group, n, n_missing, median and quartiles (numeric) or k and per cent (flags), in long form.

    One scan: each row gives one long row for each variable, aggregated by (variable, group).
    """
    parts = [F.struct(F.lit(v).alias("variable"), F.col(v).cast("double").alias("x"), F.lit(None).cast("boolean").alias("b")) for v in numeric]
    parts += [F.struct(F.lit(v).alias("variable"), F.lit(None).cast("double").alias("x"), F.col(v).cast("boolean").alias("b")) for v in flags]
    long = df.select(F.col(group).alias("group"), F.explode(F.array(*parts)).alias("v")).select("group", "v.*")
    known = F.count("x") + F.count("b")
    flags_ = [F.when(F.count("b") > 0, F.count_if("b")).alias("k"), F.when(F.count("b") > 0, F.round(F.count_if("b") * 100.0 / F.count("b"), 4)).alias("pct")]
    counts = long.groupBy("variable", "group").agg(known.alias("n"), (F.count(F.lit(1)) - known).alias("n_missing"), *flags_)
    out = _joined(counts, ranks.quantiles(long, ["variable", "group"], "x", _QUARTILES), ["variable", "group"])
    return out.select("variable", "group", "n", "n_missing", *_QUARTILES, "k", "pct")


def worst_unless_unresolved(category: str, ranks: dict[str, int], unresolved: Column, dominating: str, otherwise: str = "INDETERMINATE") -> Column:
    """Aggregate: the category of the highest rank; `otherwise` if any row is unresolved, unless the dominating category is there. Unknown categories don't count."""
    open_ = F.bool_or(F.coalesce(unresolved, F.lit(False))) & ~F.coalesce(F.bool_or(F.col(category) == dominating), F.lit(False))
    return F.when(open_, otherwise).otherwise(strongest(category, ranks))


def first_k(df: DataFrame, group: str, k: int, order: list[Column]) -> DataFrame:
    """The first k rows of each group with their rank; the limit is taken in each map task before the shuffle."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("rank") <= k)

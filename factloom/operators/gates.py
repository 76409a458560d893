"""Gates: distributions, expectations, integrity, frozen tables, golden rows, registries. A gate counts violations where the rows are; only counts reach the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distributions(df: DataFrame, columns: list[str]) -> DataFrame:
    """column, value (text, null for unknown), n: the values of several columns from one scan."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    return df.select(F.explode(cells).alias("v")).groupBy("v.column", "v.value").agg(F.count(F.lit(1)).alias("n"))


def named_gates(df: DataFrame, gates: dict[str, Column]) -> DataFrame:
    """gate, n_violations, passed of predicates that must hold in every row (an unknown predicate is broken): one scan for all gates."""
    broken = [F.count_if(~F.coalesce(ok, F.lit(False))).alias(name) for name, ok in gates.items()]
    rows = F.array(*[F.struct(F.lit(name).alias("gate"), F.col(name).alias("n_violations")) for name in gates])
    return df.agg(*broken).select(F.explode(rows).alias("g")).select("g.gate", "g.n_violations", (F.col("g.n_violations") == 0).alias("passed"))


def expectations(results: DataFrame, expected: DataFrame, keys: list[str], value: str, closed: bool = False) -> DataFrame:
    """keys, state of every expected fact: MET, DIFFERENT or MISSING; with closed also UNEXPECTED results. Null equals null."""
    left = expected.select(*keys, F.col(value).alias("__e"), F.lit(True).alias("__want"))
    right = results.select(*keys, F.col(value).alias("__g"), F.lit(True).alias("__have"))
    rows = left.join(right, keys, "full_outer" if closed else "left")
    state = F.when(F.col("__want").isNull(), "UNEXPECTED").when(F.col("__have").isNull(), "MISSING").when(F.col("__e").eqNullSafe(F.col("__g")), "MET").otherwise("DIFFERENT")
    return rows.select(*keys, state.alias("state"))


def artifact_digest(columns: list[str]) -> Column:
    """SHA-256 of the columns as text, each with its name and length, so that no two different rows are written alike."""
    part = lambda c: F.concat(F.lit(f"{c}="), F.coalesce(F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-")))
    return F.sha2(F.concat_ws("|", *[part(c) for c in columns]), 256)


def integrity(artifacts: DataFrame, group: list[str], stored: str, columns: list[str]) -> DataFrame:
    """group, n, n_changed, intact: whether every artifact's stored digest is that of its content now; a missing digest is a change."""
    same = F.col(stored).eqNullSafe(artifact_digest(columns))
    return artifacts.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), F.count_if(~same).alias("n_changed"), F.bool_and(same).alias("intact"))


def frozen(df: DataFrame, columns: list[str]) -> DataFrame:
    """n and digest of a table, whatever the order of its rows: a design that is compared with the one that was frozen."""
    part = F.conv(F.substring(artifact_digest(columns), 1, 12), 16, 10).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("n"), F.sum(part).cast("string").alias("digest"))


def version_gates(old: DataFrame, new: DataFrame, keys: list[str], value: str) -> DataFrame:
    """change, n of two versions of a result: SAME, CHANGED, GAINED (unknown before), LOST (unknown now), ADDED, REMOVED."""
    a, b = old.select(*keys, F.col(value).alias("__o"), F.lit(1).alias("__a")), new.select(*keys, F.col(value).alias("__n"), F.lit(1).alias("__b"))
    rows = a.join(b, keys, "full_outer")
    change = F.when(F.col("__a").isNull(), "ADDED").when(F.col("__b").isNull(), "REMOVED").when(F.col("__o").eqNullSafe(F.col("__n")), "SAME").when(F.col("__o").isNull(), "GAINED").when(F.col("__n").isNull(), "LOST").otherwise("CHANGED")
    return rows.groupBy(change.alias("change")).agg(F.count(F.lit(1)).alias("n"))


def golden(computed: DataFrame, expected: DataFrame, gate: str) -> DataFrame:
    """gate, violation (0 or 1) for each gate: whether its computed rows are the expected ones, as often. One aggregation of both sides by all columns."""
    columns = [c for c in expected.columns if c != gate]
    both = expected.select(gate, *columns, F.lit(1).alias("__d")).unionByName(computed.select(gate, *columns, F.lit(-1).alias("__d")))
    per = both.groupBy(gate, *columns).agg(F.sum("__d").alias("__d"))
    return per.groupBy(gate).agg(F.max((F.col("__d") != 0).cast("int")).alias("violation"))


def cardinalities(parent: DataFrame, child: DataFrame, parent_key: str, child_key: str, least: int, most: int) -> DataFrame:
    """gate, n_violations: children without a parent, and parents with fewer than `least` or more than `most` children."""
    per = child.groupBy(F.col(child_key).alias(parent_key)).agg(F.count(F.lit(1)).alias("__n"))
    rows = parent.select(parent_key, F.lit(True).alias("__p")).join(per, parent_key, "full_outer")
    n = F.coalesce("__n", F.lit(0))
    counts = rows.agg(F.sum(F.when(F.col("__p").isNull(), n).otherwise(0)).alias("orphans"), F.count_if(F.col("__p") & (n < least)).alias("too_few"), F.count_if(F.col("__p") & (n > most)).alias("too_many"))
    return counts.select(F.explode(F.array(*[F.struct(F.lit(g).alias("gate"), F.coalesce(F.col(g), F.lit(0)).cast("bigint").alias("n_violations")) for g in ("orphans", "too_few", "too_many")])).alias("g")).select("g.*")


def registry(uses: DataFrame, symbol: str, registered: list[str]) -> DataFrame:
    """symbol, registered, n of every symbol that is registered or used, n its uses: 0 for one that nothing uses. Unknown symbols of the rows (null) are one of their own.
    The registry is a short list of names."""
    known = uses.sparkSession.createDataFrame([(x,) for x in sorted(set(registered))], f"`{symbol}` string").withColumn("registered", F.lit(True))
    used = uses.groupBy(F.col(symbol).cast("string").alias("__s")).agg(F.count(F.lit(1)).alias("n"))
    rows = used.join(known, F.col("__s").eqNullSafe(F.col(symbol)), "full_outer")
    return rows.select(F.coalesce("__s", symbol).alias(symbol), F.coalesce("registered", F.lit(False)).alias("registered"), F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))

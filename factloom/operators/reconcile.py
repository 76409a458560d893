"""Idempotent loads, snapshot differences, versions, closures, logs. Tables are append-only; plans say what to append and why."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def plan_load(candidates: DataFrame, stored: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """candidates with status: insert (key unknown), skip (one equal row stored), conflict (one other row), ambiguous (several rows on a side)."""
    own = candidates.groupBy(*keys).agg(F.count(F.lit(1)).alias("__c"), *[F.min(v).alias(v) for v in values])
    there = stored.groupBy(*keys).agg(F.count(F.lit(1)).alias("__s"), *[F.min(v).alias(f"__{v}") for v in values])
    rows = own.join(there, keys, "left")
    same = F.lit(True)
    for v in values:
        same = same & F.col(v).eqNullSafe(F.col(f"__{v}"))
    status = F.when((F.col("__c") > 1) | (F.col("__s") > 1), "ambiguous").when(F.col("__s").isNull(), "insert").when(same, "skip").otherwise("conflict")
    return rows.select(*keys, *values, status.alias("status"))


def snapshot_diff(old: DataFrame, new: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """keys, change: ADDED, REMOVED, CHANGED or UNCHANGED (null equals null), and the changed columns, comma-joined."""
    a = old.select(*keys, *[F.col(v).alias(f"__o_{v}") for v in values], F.lit(True).alias("__o"))
    b = new.select(*keys, *[F.col(v).alias(f"__n_{v}") for v in values], F.lit(True).alias("__n"))
    changed = F.array_compact(F.array(*[F.when(~F.col(f"__o_{v}").eqNullSafe(F.col(f"__n_{v}")), v) for v in values]))
    both = F.col("__o").isNotNull() & F.col("__n").isNotNull()
    change = F.when(F.col("__o").isNull(), "ADDED").when(F.col("__n").isNull(), "REMOVED").when(F.size(changed) > 0, "CHANGED").otherwise("UNCHANGED")
    return a.join(b, keys, "full_outer").select(*keys, change.alias("change"), F.when(both, F.array_join(changed, ",")).otherwise("").alias("changed_columns"))


def fill_nulls(stored: DataFrame, incoming: DataFrame, key: str, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Merged rows (stored values win, nulls are filled), and column, filled, equal, conflict counts."""
    rows = stored.join(incoming.select(key, *[F.col(c).alias(f"__{c}") for c in columns]), key, "left")
    merged = rows.select(*[F.coalesce(c, f"__{c}").alias(c) if c in columns else F.col(c) for c in stored.columns])
    states = [F.struct(F.lit(c).alias("column"), (F.col(c).isNull() & F.col(f"__{c}").isNotNull()).alias("f"), (F.col(c) == F.col(f"__{c}")).alias("e"), (F.col(c) != F.col(f"__{c}")).alias("x")) for c in columns]
    counts = rows.select(F.explode(F.array(*states)).alias("s")).select("s.*").groupBy("column").agg(F.count_if("f").alias("filled"), F.count_if("e").alias("equal"), F.count_if("x").alias("conflict"))
    return merged, counts


def insert_missing(incoming: DataFrame, stored: DataFrame, keys: list[str]) -> DataFrame:
    """incoming rows whose key is not stored."""
    return incoming.join(stored.select(*keys).distinct(), keys, "left_anti")


def latest_valid(entries: DataFrame, module: str, version: str, created: str, valid: Column) -> DataFrame:
    """Per module the newest valid entry; of entries of one version the last one counts, whether or not it is valid. Two aggregations, no window."""
    cols = [c for c in entries.columns if c not in (module, version)]
    last = entries.withColumn("__ok", valid).groupBy(module, version).agg(F.max_by(F.struct(*cols, "__ok"), created).alias("e")).select(module, version, "e.*")
    best = last.where("__ok").groupBy(module).agg(F.max_by(F.struct(version, *cols), F.struct(created, version)).alias("e"))
    return best.select(module, "e.*")


def active_or_latest(entries: DataFrame, active: DataFrame, module: str, version: str, created: str) -> DataFrame:
    """Per module the active version if one is set and present, else the newest."""
    rows = entries.join(active.select(module, F.col(version).alias("__active")), module, "left")
    order = F.struct((F.col(version).eqNullSafe(F.col("__active"))).alias("a"), F.col(created).alias("c"), F.col(version).alias("v"))
    return rows.groupBy(module).agg(F.max_by(version, order).alias(version))


def closure(edges: DataFrame, source: str, target: str, start: DataFrame | None = None) -> DataFrame:
    """source, target of all paths (from the start nodes, if given): joins to the fixpoint, each round cut by a written table."""
    from factloom.sources.work import appended, written

    step = written(edges.select(F.col(source).alias("s"), F.col(target).alias("t")).where("s is not null and t is not null").distinct(), "step")
    own = step if start is None else step.join(start.select(F.col(start.columns[0]).alias("s")).distinct(), "s", "left_semi")
    # each round appends what is new to one folder, so that no round writes again what others have reached
    path = appended(own, "reached")
    spark, schema, rounds = edges.sparkSession, own.schema, 0
    reached = lambda: spark.read.schema(schema).parquet(*[f"{path}/{k}" for k in range(rounds + 1)])
    new = spark.read.schema(schema).parquet(f"{path}/0")
    while new.limit(1).count():
        found = new.join(step.select(F.col("s").alias("t"), F.col("t").alias("u")), "t").select("s", F.col("u").alias("t")).distinct()
        found.join(reached(), ["s", "t"], "left_anti").write.parquet(f"{path}/{rounds + 1}")
        rounds += 1
        new = spark.read.schema(schema).parquet(f"{path}/{rounds}")
    reached = reached()
    return reached.select(F.col("s").alias(source), F.col("t").alias(target))


def stale(edges: DataFrame, changed: DataFrame, module: str, depends_on: str) -> DataFrame:
    """Modules that depend on a changed one, directly or not, and are not changed themselves."""
    down = closure(edges.select(F.col(depends_on).alias("a"), F.col(module).alias("b")), "a", "b", changed)
    return down.select(F.col("b").alias(module)).distinct().join(changed.select(F.col(changed.columns[0]).alias(module)), module, "left_anti")


def latest_per_key(log: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Projection of an append-only log: the last record of each key."""
    cols = [c for c in log.columns if c not in keys]
    return log.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.struct(*order)).alias("r")).select(*keys, "r.*")


def overlay(raw: DataFrame, latest: DataFrame, key: str, value: str, hash_: str) -> DataFrame:
    """raw with the last review applied: EDIT replaces the value, REJECT empties it, RESET or none keeps it; other hash: stale and kept.

    latest has key, action, new_value, source_hash.
    """
    rows = raw.join(latest.select(key, "action", "new_value", "source_hash"), key, "left")
    is_stale = F.coalesce(F.col("source_hash") != F.col(hash_), F.lit(False)) & ~F.coalesce(F.col("action") == "RESET", F.lit(True))
    shown = F.when(is_stale | F.col("action").isNull(), F.col(value)).when(F.col("action") == "EDIT", F.col("new_value")).when(F.col("action") == "REJECT", F.lit(None)).otherwise(F.col(value))
    state = F.when(F.col("action").isNull() | (F.col("action") == "RESET"), "OPEN").when(is_stale, "STALE").otherwise(F.col("action"))
    return rows.select(*raw.columns, shown.alias("shown"), state.alias("review_state"))


def promote(entries: DataFrame, requests: DataFrame, active: DataFrame, module: str, version: str) -> DataFrame:
    """New active table. A request (module, version, expected_version) moves the pointer only if the active version is the expected one and the entry is valid."""
    rows = requests.join(active.select(module, F.col(version).alias("__now")), module, "left").join(entries.where("valid").select(module, version).distinct().withColumn("__there", F.lit(True)), [module, version], "left")
    ok = F.col("__now").eqNullSafe(F.col("expected_version")) & F.coalesce("__there", F.lit(False))
    moved = rows.where(ok).groupBy(module).agg(F.min(version).alias("__new"), F.count(F.lit(1)).alias("__n")).where("__n = 1")
    return active.join(moved, module, "full_outer").select(module, F.coalesce("__new", version).alias(version))


def with_candidates(members: DataFrame, candidates: DataFrame, family: str, member: str, day: str) -> DataFrame:
    """family, first_day, members (sorted, comma-joined), n, candidate: candidates count only in families that have no member of their own."""
    cols = [family, member, day]
    extra = candidates.select(*cols).join(members.select(family).distinct(), family, "left_anti").withColumn("candidate", F.lit(True))
    rows = members.select(*cols).withColumn("candidate", F.lit(False)).unionByName(extra)
    ids = F.array_join(F.transform(F.array_sort(F.collect_set(member)), lambda x: x.cast("string")), ",")
    return rows.groupBy(family).agg(F.min(F.to_date(day)).alias("first_day"), ids.alias("members"), F.count(F.lit(1)).alias("n"), F.bool_or("candidate").alias("candidate"))


def patch_conflicts(current: DataFrame, patch: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """key, column, state of every column that a patch states: fills (nothing there), same, or conflict. A patch's nulls state nothing."""
    rows = current.select(key, *columns).join(patch.select(key, *[F.col(c).alias(f"__{c}") for c in columns]), key)
    state = lambda c: F.when(F.col(f"__{c}").isNull(), None).when(F.col(c).isNull(), "fills").when(F.col(c) == F.col(f"__{c}"), "same").otherwise("conflict")
    states = F.filter(F.array(*[F.struct(F.lit(c).alias("column"), state(c).alias("state")) for c in columns]), lambda s: s["state"].isNotNull())
    return rows.select(key, F.explode(states).alias("s")).select(key, "s.*")

"""Running states of keys of any size: scans in parts.

Rows are dealt to ranges of (key, order) and written; a window runs inside each key's part of a range; the parts' last states, a row for each key and range, are combined
in order and given to the next. A key that holds most rows so spreads over many tasks. States are those whose parts combine: see COMBINE.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.sources.work import written

#: kind -> (aggregate of a part, state of a part after that of what is before it)
COMBINE: dict[str, tuple[Callable[[Column], Column], Callable[[Column, Column], Column]]] = {
    "max": (F.max, lambda before, own: F.greatest(before, own)),
    "min": (F.min, lambda before, own: F.least(before, own)),
    "any": (F.bool_or, lambda before, own: F.when(before | own, True).otherwise(F.coalesce(before, own))),
    "all": (F.bool_and, lambda before, own: F.when(~before | ~own, False).otherwise(F.coalesce(before, own))),
    "sum": (F.sum, lambda before, own: F.coalesce(before + own, before, own)),
    "last": (lambda c: F.last(c, ignorenulls=True), lambda before, own: F.coalesce(own, before)),
    "first": (lambda c: F.first(c, ignorenulls=True), lambda before, own: F.coalesce(before, own)),
}
_SPAN = {True: (Window.unboundedPreceding, Window.currentRow), False: (Window.unboundedPreceding, -1)}


def _same(keys: list[str]) -> Column:
    same = F.col("__range") == F.col("__r")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return same


def running(df: DataFrame, keys: list[str], order: list[str], states: dict[str, tuple[str, Column]], *, current: bool = True, earlier: dict[str, str] | None = None) -> DataFrame:
    """df with a column for each state: name -> (kind in COMBINE, value), over the rows of the key up to this one (without it if not current), in order, which must
    be total; and for each name -> state in `earlier` that state without this row. Null values change nothing; a state without a value is null. Null keys are a
    key, null orders come first."""
    ranged = df
    for n, (_, value) in states.items():
        ranged = ranged.withColumn(f"__v_{n}", value)
    ranged = written(ranged.repartitionByRange(*[F.col(c) for c in (*keys, *order)]).withColumn("__range", F.spark_partition_id()), "ranged")
    inside = Window.partitionBy(*keys, "__range").orderBy(*order)
    wanted = {n: (n, current) for n in states} | {n: (of, False) for n, of in (earlier or {}).items()}
    own = ranged.withColumns({f"__o_{n}": COMBINE[states[of][0]][0](F.col(f"__v_{of}")).over(inside.rowsBetween(*_SPAN[now])) for n, (of, now) in wanted.items()})
    ordered = F.struct(*order)
    ends = []
    for n, (kind, _) in states.items():
        value = F.col(f"__v_{n}")
        # last and first of a part by the order; what has no value doesn't count
        ends.append((F.max_by(value, F.when(value.isNotNull(), ordered)) if kind == "last" else F.min_by(value, F.when(value.isNotNull(), ordered)) if kind == "first" else COMBINE[kind][0](value)).alias(f"__e_{n}"))
    parts = ranged.groupBy(*keys, "__range").agg(*ends)
    # one row for each key and range: their running states are those of all ranges before
    parts_before = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("__range").alias("__r"), *[COMBINE[kind][0](F.col(f"__e_{n}")).over(parts_before).alias(f"__b_{n}") for n, (kind, _) in states.items()])
    both = own.join(offsets, _same(keys))
    return both.select(*df.columns, *[COMBINE[states[of][0]][1](F.col(f"__b_{of}"), F.col(f"__o_{n}")).alias(n) for n, (of, _) in wanted.items()])


def before(df: DataFrame, keys: list[str], order: list[str], value: Column, out: str) -> DataFrame:
    """df with `out`: the last known value of the rows of the key before this one."""
    return running(df, keys, order, {out: ("last", value)}, current=False)


def state_changes(df: DataFrame, keys: list[str], order: list[str], states: dict[str, tuple[str, Column]], state: Column, out: str = "state") -> DataFrame:
    """Rows at which `state`, an expression of the running states, differs from that of the row before (or has none before); df's columns and `out`."""
    counted = {**states, "__row": ("sum", F.lit(1))}
    both = running(df, keys, order, counted, earlier={f"__x_{n}": n for n in counted})
    # the same expression, over the states with and without this row
    now = both.withColumn(out, state).select(*df.columns, out, *[F.col(f"__x_{n}").alias(n) for n in counted])
    old = now.withColumn("__old", state)
    return old.where(F.col("__row").isNull() | ~F.col("__old").eqNullSafe(F.col(out))).select(*df.columns, out)

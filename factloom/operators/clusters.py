"""Order-dependent grouping inside small keys: partial dates, visual rows, overlapping spans. One key (a person, a page) is a group of bounded size."""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _agree(a: tuple, b: tuple) -> bool:
    return all(x is None or y is None or x == y for x, y in zip(a, b, strict=True))


def date_clusters(mentions: DataFrame, key: list[str], mention: str, year: str, month: str, day: str) -> DataFrame:
    """key, mention, cluster: mentions by precision (day, month, year, unknown) join the only cluster all of whose dates agree with theirs; with none they
    start one, with several they stay apart (cluster null: held). Mentions of one date have one cluster, so the distinct dates of a key are clustered, which
    its calendar bounds, and then joined to its mentions."""
    named = [f"__k_{k}" for k in key]

    def clustered(dates: list[tuple]) -> list[int | None]:
        order = sorted(range(len(dates)), key=lambda i: (-sum(x is not None for x in dates[i]), tuple(-1 if x is None else x for x in dates[i])))
        clusters: list[list[tuple]] = []
        out: list[int | None] = [None] * len(dates)
        for i in order:
            # different whole dates never agree, and they come first
            fit = [] if None not in dates[i] else [c for c, members in enumerate(clusters) if all(_agree(dates[i], m) for m in members)]
            if len(fit) > 1:
                continue
            if not fit:
                clusters.append([])
                fit = [len(clusters) - 1]
            clusters[fit[0]].append(dates[i])
            out[i] = fit[0] + 1
        return out

    def run(batches):
        for batch in batches:
            of, dates, found = [], [], []
            for i, own in enumerate(batch.column(len(named)).to_pylist()):
                own = [(d["__y"], d["__m"], d["__d"]) for d in own]
                of += [i] * len(own)
                dates += own
                found += clustered(own)
            parts = [pa.array([d[k] for d in dates], pa.int32()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([*[batch.column(k).take(pa.array(of, pa.int64())) for k in range(len(named))], *parts, pa.array(found, pa.int64())], names=[*named, "__y", "__m", "__d", "cluster"])

    parts = [F.col(c).cast("int").alias(n) for c, n in ((year, "__y"), (month, "__m"), (day, "__d"))]
    dates = mentions.select(*[F.col(k).alias(n) for k, n in zip(key, named, strict=True)], F.struct(*parts).alias("__s"))
    kinds = dict(dates.dtypes)
    schema = ", ".join(f"`{n}` {kinds[n]}" for n in named) + ", __y int, __m int, __d int, cluster long"
    found = dates.groupBy(*named).agg(F.collect_set("__s").alias("__s")).mapInArrow(run, schema)
    same = F.col(year).eqNullSafe(F.col("__y")) & F.col(month).eqNullSafe(F.col("__m")) & F.col(day).eqNullSafe(F.col("__d"))
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"__k_{k}"))
    return mentions.join(found, same).select(*key, mention, "cluster")


def visual_rows(tokens: DataFrame, key: list[str], token: str, y: str, tolerance: float) -> DataFrame:
    """key, token, row_no: tokens from top to bottom join the row whose running mean of y is within the tolerance."""
    kinds = dict(tokens.dtypes)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values([y, token], kind="stable")
        number, total, n, out = 0, 0.0, 0, []
        for value in rows[y]:
            if not n or abs(value - total / n) > tolerance:
                number, total, n = number + 1, 0.0, 0
            total, n = total + value, n + 1
            out.append(number)
        return rows[[*key, token]].assign(row_no=out)

    schema = ", ".join(f"{c} {kinds[c]}" for c in (*key, token)) + ", row_no int"
    return tokens.groupBy(*key).applyInPandas(run, schema)


def without_overlaps(spans: DataFrame, key: list[str], start: str, end: str) -> DataFrame:
    """Spans in order of start (longer first), each kept if it begins at or after the end of the last kept one. Sorted rows stream by, with the last end in memory."""
    names = spans.columns

    def run(batches):
        of, last, first = None, None, True
        for batch in batches:
            col = lambda c: batch.column(names.index(c)).to_pylist()  # noqa: E731, B023
            keep = []
            for k, a, b in zip(zip(*[col(c) for c in key], strict=True), col(start), col(end), strict=True):
                if k != of:
                    of, first = k, True
                ok = first or (a is not None and last is not None and a >= last)
                if ok:
                    last, first = b, False
                keep.append(ok)
            yield batch.filter(pa.array(keep, pa.bool_()))

    rows = spans.repartition(*key).sortWithinPartitions(*key, F.asc_nulls_last(start), F.desc_nulls_last(end))
    return rows.mapInArrow(run, spans.schema)


def replay(items: DataFrame, events: DataFrame, artifact: str) -> DataFrame:
    """Items of an artifact after its review events in order: artifact, key, value, state.

    items has key and value; events have at, action, key, new_key and value. ACCEPT, REJECT and UNCERTAIN set the state, EDIT the value too, SPLIT adds new_key
    with the event's value (else the old one), MERGE takes key away in favour of new_key. Events on keys that aren't there, SPLITs onto keys that are and
    MERGEs into keys that aren't change nothing; events of one time follow action and key. Each step depends on the one before, so one artifact's rows stream
    through one task in order, after its items; in memory are its keys.
    """
    kind = dict(items.dtypes)[artifact]
    text = lambda c: F.col(c).cast("string").alias(c)
    left = items.select(artifact, F.lit(0).alias("__event"), text("key"), text("value"))
    right = events.select(artifact, F.lit(1).alias("__event"), "at", "action", text("key"), text("new_key"), text("value"))
    states = {"ACCEPT": "ACCEPTED", "REJECT": "REJECTED", "UNCERTAIN": "UNCERTAIN"}

    def run(batches):
        of, now, out, form = None, {}, [], None

        def table():
            columns = zip(*out, strict=True) if out else [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (form, pa.string(), pa.string(), pa.string()), strict=True)], names=[artifact, "key", "value", "state"])

        for batch in batches:
            form = batch.schema.field(0).type
            for whose, event, action, key, new, value in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if whose != of:
                    out += [(of, k, v, s) for k, (v, s) in now.items()]
                    of, now = whose, {}
                if not event:
                    now[key] = value, "OPEN"
                elif key not in now:
                    continue
                elif action in states:
                    now[key] = now[key][0], states[action]
                elif action == "EDIT":
                    now[key] = value, "EDITED"
                elif action == "SPLIT" and new is not None and new not in now:
                    now[new] = now[key][0] if value is None else value, "OPEN"
                elif action == "MERGE" and new in now and new != key:
                    del now[key]
            yield table()
            out = []
        out = [(of, k, v, s) for k, (v, s) in now.items()]
        if out:
            yield table()

    last = F.asc_nulls_last
    rows = left.unionByName(right, allowMissingColumns=True).repartition(artifact).sortWithinPartitions(artifact, "__event", last("at"), last("action"), last("key"), last("new_key"), last("value"))
    return rows.select(artifact, "__event", "action", "key", "new_key", "value").mapInArrow(run, f"`{artifact}` {kind}, key string, value string, state string")

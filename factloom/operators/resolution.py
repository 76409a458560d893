"""Entity resolution with anchors: records that share a key belong together, but no entity has two official ids, nor two values of a single-valued attribute."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.operators import identity
from factloom.sources.work import written

ANCHORED, FREE, AMBIGUOUS, INCOHERENT = "ANCHORED", "FREE", "AMBIGUOUS", "INCOHERENT"


def key_edges(records: DataFrame, record: str, keys: list[list[str]]) -> DataFrame:
    """u, v, key_no: an edge from every record to the smallest one with the same values of a key (all of them known). A key of any size gives a star, not all pairs."""
    out = None
    for i, names in enumerate(keys):
        known = records.select(F.col(record).alias("v"), *names).where(" AND ".join(f"`{n}` IS NOT NULL" for n in names))
        least = known.groupBy(*names).agg(F.min("v").alias("u"))
        part = known.join(least, names).where("u <> v").select("u", "v", F.lit(i).alias("key_no"))
        out = part if out is None else out.unionByName(part)
    return out.distinct()


def reach(records: DataFrame, edges: DataFrame, record: str, anchor: str) -> DataFrame:
    """record, anchor, met: the anchor that reaches a record first, in rounds of one edge. Where two meet first, or what is behind such a record, anchor is null and
    met true; records that no anchor reaches have no row. Rounds go on until none is new; each is written, so lost executors cost one round."""
    both = written(edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    front = written(records.where(F.col(anchor).isNotNull()).select(F.col(record).alias("v"), F.col(anchor).cast("string").alias("a"), F.lit(False).alias("met")), "front")
    known = front
    while front.limit(1).count():
        steps = front.withColumnRenamed("v", "u").join(both, "u").join(known.select("v"), "v", "left_anti")
        # the first and the last anchor of a round tell whether there are two
        new = steps.groupBy("v").agg(F.min("a").alias("a"), F.max("a").alias("b"), F.max("met").alias("m"))
        apart = F.col("m") | (F.col("a") != F.col("b"))
        front = written(new.select("v", F.when(~apart, F.col("a")).alias("a"), apart.alias("met")), "front")
        known = written(known.unionByName(front), "known")
    return known.select(F.col("v").alias(record), F.col("a").alias("anchor"), "met")


def resolve(records: DataFrame, edges: DataFrame, record: str, anchor: str, single: list[str]) -> DataFrame:
    """record, entity, state, n_records for each record (record ids are unique).

    ANCHORED: entity is `A:` and the one anchor that reaches the record first. AMBIGUOUS: two anchors reach it first, entity is null. FREE: none does, entity is `R:`
    and the smallest record of its component. INCOHERENT: its entity has two known values of an attribute in `single`; entity is null, n_records is that of
    what was held together. So no entity has two anchors, whatever chains the edges make. Records without edges stand alone.
    """
    reached = reach(records, edges, record, anchor)
    near = records.join(reached, record, "left").withColumn("met", F.coalesce("met", F.lit(False)))
    loose = near.where("anchor IS NULL AND NOT met").select(record)
    # edges of the records that no anchor reaches stay among them
    among = edges.join(loose.select(F.col(record).alias("u")), "u", "left_semi").join(loose.select(F.col(record).alias("v")), "v", "left_semi")
    free = identity.components(among, "u", "v").withColumnRenamed("id", record)
    rows = near.join(free, record, "left")
    group = F.when(F.col("anchor").isNotNull(), F.concat(F.lit("A:"), "anchor")).when(~F.col("met"), F.concat(F.lit("R:"), F.coalesce("component", record).cast("string")))
    rows = rows.select(record, *single, "met", F.col("anchor").alias("__a"), group.alias("__e"))
    at_most_one = F.lit(True)
    for c in single:
        at_most_one = at_most_one & F.coalesce(F.min(c) == F.max(c), F.lit(True))
    sizes = rows.where("__e IS NOT NULL").groupBy("__e").agg(F.count(F.lit(1)).alias("n_records"), at_most_one.alias("__ok"))
    found = rows.join(sizes, "__e", "left")
    state = F.when(F.col("met"), AMBIGUOUS).when(~F.col("__ok"), INCOHERENT).when(F.col("__a").isNotNull(), ANCHORED).otherwise(FREE)
    return found.select(record, F.when(F.col("__ok"), F.col("__e")).alias("entity"), state.alias("state"), "n_records")


def conflicts(records: DataFrame, edges: DataFrame, record: str, anchor: str) -> DataFrame:
    """u, v, key_no, anchor_u, anchor_v of the edges that would join two anchors: their ends lie with different ones, or one of them with none because two meet there."""
    reached = reach(records, edges, record, anchor)
    side = lambda c: reached.select(F.col(record).alias(c), F.col("anchor").alias(f"anchor_{c}"), F.col("met").alias(f"met_{c}"))
    rows = edges.join(side("u"), "u").join(side("v"), "v")
    return rows.where("met_u OR met_v OR anchor_u <> anchor_v").select("u", "v", "key_no", "anchor_u", "anchor_v")


def continuity_edges(events: DataFrame, keys: list[str], event: str, time: str, gap_seconds: int) -> DataFrame:
    """u, v: every event and the one before it in its key (by time, then id) if at most gap_seconds lie between. The one before comes from a scan in parts."""
    from factloom.operators.scans import before

    rows = before(events.select(*keys, event, time).where(F.col(time).isNotNull()), keys, [time, event], F.struct(F.col(event).alias("id"), F.col(time).alias("at")), "last")
    near = F.unix_micros(F.col(time).cast("timestamp")) - F.unix_micros(F.col("last.at").cast("timestamp")) <= gap_seconds * 1_000_000
    return rows.where(near).select(F.col("last.id").alias("u"), F.col(event).alias("v"))

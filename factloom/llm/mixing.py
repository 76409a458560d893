"""Mixing sources to target weights by balanced sampling with the cube method.

Each source's target T asks for mu = T / (its size) copies of every document: floor(mu) copies are certain, the rest is an inclusion
probability. The cube method settles it: inside a block of documents, probabilities walk in the null space of the constraints
(sum of sizes, number of documents), so both totals stay what they were, until only as many probabilities are fractional as there
are constraints. What is left of all blocks meets in fewer blocks, and so on, until one small landing problem is left for each source; it is
settled by the choice that comes nearest to the totals, and swaps with other documents of that problem close the gap that remains.

Defined results: null texts have size 0, documents of size 0 take part (their taken words are 0); repeated rows are documents of
their own; a null source is a source, ordered last; an empty table gives an empty result. All random choices come from a fixed seed and
rows are put in order inside a block, so reruns over the same files agree. Extra columns are left out of op10 and kept by `mix`.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factloom.llm.common import documents, unused, written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS, TOTAL, MOST = (3, 1, 2), 1.5, 2.0
#: Documents of a source that are settled together.
BLOCK = 4096
SEED = 10
#: Swaps that are tried in a landing problem; rows of facts that are broadcast; groups of rows that repeat id, size and source.
REPAIRS, BROADCAST_SOURCES, SALTS = 64, 100_000, 64


def targets(sizes: dict[str | None, int]) -> dict[str | None, float]:
    """Target of each source: its weight's share of TOTAL times all sizes, at most MOST times its size; the excess goes to the others by weight."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: WEIGHTS[i % len(WEIGHTS)] for i, s in enumerate(names)}
    left, open_, out = TOTAL * sum(sizes.values()), set(names), {}
    while open_:
        unit = left / sum(weight[s] for s in open_)
        full = [s for s in names if s in open_ and unit * weight[s] > MOST * sizes[s]]
        if not full:
            return out | {s: unit * weight[s] for s in names if s in open_}
        for s in full:
            out[s] = MOST * sizes[s]
            left -= out[s]
            open_.discard(s)
    return out


def flight(p: np.ndarray, sizes: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Flight phase: p moved so that sum(p) and sum(p * sizes) stay, until at most two entries are fractional."""
    p = p.astype(float).copy()
    waiting = np.flatnonzero((p > 1e-9) & (p < 1 - 1e-9)).tolist()[::-1]
    coins = rng.random(len(waiting) + 1).tolist()
    active: list[int] = []
    while True:
        while len(active) < 3 and waiting:
            active.append(waiting.pop())
        if len(active) < 3:
            break
        i, j, k = active
        a, b, c = float(sizes[i]), float(sizes[j]), float(sizes[k])
        u = (b - c, c - a, a - b) if not a == b == c else (1.0, -1.0, 0.0)  # null space of the two constraints
        up = min((1 - p[x]) / v if v > 0 else -p[x] / v for x, v in zip(active, u, strict=True) if v)
        down = min(p[x] / v if v > 0 else (p[x] - 1) / v for x, v in zip(active, u, strict=True) if v)
        step = up if coins[len(waiting) % len(coins)] * (up + down) < down else -down
        coins[len(waiting) % len(coins)] = (coins[len(waiting) % len(coins)] * 7919.0 + 0.5) % 1.0
        for x, v in zip(active, u, strict=True):
            p[x] = min(1.0, max(0.0, p[x] + step * v))
        active = [x for x in active if 1e-9 < p[x] < 1 - 1e-9]
    p[p <= 1e-9], p[p >= 1 - 1e-9] = 0.0, 1.0
    return p


def landing(p: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The few fractional entries become 0 or 1: the choice nearest to their totals of size, then of documents."""
    p, open_ = p.copy(), np.flatnonzero((p > 0) & (p < 1))
    want, number = float(p[open_] @ sizes[open_]), float(p[open_].sum())
    best = min(product((0.0, 1.0), repeat=len(open_)), key=lambda x: (round(abs(float(np.dot(x, sizes[open_])) - want), 6), abs(sum(x) - number), x)) if len(open_) else ()
    p[open_] = best
    return p


def repair(p: np.ndarray, sizes: np.ndarray, open_: np.ndarray, want: float) -> np.ndarray:
    """Settled entries (of open_, those that may change) swapped two by two while that brings the taken size nearer to `want`."""
    p = p.copy()
    for _ in range(REPAIRS):
        gap = want - float(p @ sizes)
        ones, zeros = open_[p[open_] == 1], open_[p[open_] == 0]
        if not len(ones) or not len(zeros):
            break
        zeros = zeros[np.argsort(sizes[zeros], kind="stable")]
        # each one's best partner is the zero whose size is nearest to its own plus the gap
        at = np.searchsorted(sizes[zeros], sizes[ones] + gap)
        near = np.stack([np.clip(at - 1, 0, len(zeros) - 1), np.clip(at, 0, len(zeros) - 1)])
        left = np.abs(gap + sizes[ones] - sizes[zeros[near]])
        k, i = np.unravel_index(int(left.argmin()), left.shape)
        if left[k, i] >= abs(gap) - 1e-6:
            break
        p[ones[i]], p[zeros[near[k, i]]] = 0.0, 1.0
    return p


def _settle(last: bool):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["h", "doc_id", "size"], kind="stable", na_position="first").reset_index(drop=True)
        sizes, before = rows["size"].to_numpy(float), rows["p"].to_numpy(float)
        p = flight(before, sizes, np.random.default_rng([SEED, int(rows["block"].iloc[0]), len(rows)]))
        if last:
            p = repair(landing(p, sizes), sizes, np.flatnonzero((before > 1e-9) & (before < 1 - 1e-9)), float(before @ sizes))
        rows["p"] = p
        return rows

    return run


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, size, source and a number of each row, written."""
    return written(docs.select("doc_id", size_of().alias("size"), "source", F.monotonically_increasing_id().alias("nth")), "sized")


def copies(sized: DataFrame) -> DataFrame:
    """sized(doc_id, size, source, nth) with source_size, target and copies (whole number) of each row."""
    per = {r["source"]: (r["words"], r["n"]) for r in sized.groupBy("source").agg(F.sum("size").alias("words"), F.count("*").alias("n")).collect()}
    want = targets({s: w for s, (w, _) in per.items()})
    spark = sized.sparkSession
    facts = [(s, int(w), float(want[s]), want[s] / w if w else 0.0, max(1, -(-n // BLOCK))) for s, (w, n) in per.items()]
    facts = spark.createDataFrame(facts, "s string, source_size long, target double, mu double, blocks int")
    facts = F.broadcast(facts) if len(per) <= BROADCAST_SOURCES else facts
    # rows that repeat an id and size would all be in one block: where there are many, their numbers deal them to several
    often = sized.groupBy("doc_id", "size").count().where(F.col("count") > BLOCK // 4).select(F.col("doc_id").alias("o"), F.col("size").alias("z"))
    n_often = often.count()
    rows, h = sized, F.xxhash64(F.lit(SEED), "doc_id", "size")
    if n_often:
        often = F.broadcast(often) if n_often <= BROADCAST_SOURCES else often
        rows = rows.join(often, F.col("doc_id").eqNullSafe(F.col("o")) & (F.col("size") == F.col("z")), "left")
        h = F.when(F.col("z").isNull(), h).otherwise(F.xxhash64(h, "nth"))
    rows = rows.join(facts, F.col("source").eqNullSafe(F.col("s"))).withColumn("h", h)
    rows = rows.select("doc_id", "size", "source", "nth", "source_size", "target", F.floor("mu").cast("int").alias("base"), (F.col("mu") - F.floor("mu")).alias("p"), "h", F.pmod(F.shiftright("h", 20), F.col("blocks")).cast("int").alias("block"))
    parts, blocks = [], max((-(-n // BLOCK) for _, n in per.values()), default=1)
    while True:
        last = blocks <= 1
        schema = rows.schema
        done = written(rows.groupBy("source", "block").applyInPandas(_settle(last), schema), "mixed")
        parts.append(done if last else done.where("p in (0, 1)"))
        if last:
            break
        blocks = -(-blocks * 2 // BLOCK)  # two fractional documents a block are left at most
        rows = done.where("p not in (0, 1)").withColumn("block", (F.col("block") % blocks).cast("int"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select("doc_id", "size", "source", "nth", "source_size", "target", (F.col("base") + F.col("p").cast("int")).alias("copies"))


def size_of(text: str = "text"):
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mix(docs: DataFrame) -> DataFrame:
    """docs with every row as often as the mix takes it.

    Rows that agree in id, size and source share their copies: SALTS groups of them get equal parts of the copies beyond the least, each group's first rows
    in order of the text.
    """
    names = docs.columns
    size, salt, one, i, o, z, s, low, more, n = unused(docs, "size", "salt", "one", "i", "o", "z", "s", "low", "more", "n")
    key = [F.col("doc_id").alias(o), F.col("size").alias(z), F.col("source").alias(s)]
    facts = copies(sized(docs)).groupBy("doc_id", "size", "source").agg(F.min("copies").alias(low), F.sum("copies").alias("all"), F.count("*").alias(n))
    facts = facts.select(*key, low, (F.col("all") - F.col(low) * F.col(n)).alias(more), n)
    same = F.col("doc_id").eqNullSafe(F.col(o)) & (F.col(size) == F.col(z)) & F.col("source").eqNullSafe(F.col(s))
    joined = docs.withColumn(size, size_of()).join(facts, same)
    single = joined.where(F.col(n) == 1).withColumn(i, F.col(low))
    several = joined.where(F.col(n) > 1).withColumn(salt, F.pmod(F.monotonically_increasing_id(), F.least(F.lit(SALTS), F.col(n))).cast("int"))
    several = written(several, "repeated")  # the numbers of rows must not change between the two uses
    group = Window.partitionBy(o, z, s)
    shares = several.groupBy(o, z, s, salt).agg(F.count("*").alias(one), F.first(more).alias(more), F.first(n).alias(n))
    upto = F.sum(one).over(group.orderBy(salt))
    part = lambda x: F.floor(F.col(more) * x / F.col(n))
    shares = shares.withColumn(one, (part(upto) - part(upto - F.col(one))).cast("long")).select(*[F.col(c).alias(f"{c}2") for c in (o, z, s, salt)], one)
    rank = F.row_number().over(Window.partitionBy(o, z, s, salt).orderBy("text"))
    fits = F.col(o).eqNullSafe(F.col(f"{o}2")) & (F.col(z) == F.col(f"{z}2")) & F.col(s).eqNullSafe(F.col(f"{s}2")) & (F.col(salt) == F.col(f"{salt}2"))
    several = several.withColumn(i, rank).join(shares, fits).withColumn(i, F.col(low) + (F.col(i) <= F.col(one)).cast("int"))
    rows = single.select(*names, i).unionByName(several.select(*names, i))
    return rows.withColumn(n, F.explode(F.array_repeat(F.lit(True), F.col(i).cast("int")))).select(*names)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copies(sized(documents(spark, sf_dir))).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))

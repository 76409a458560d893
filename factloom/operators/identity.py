"""Record linkage: name forms, blocked graded matches, cardinality with ambiguity, partitions of id sets, components.

Links are equi-joins on a block key (a date, a number, a place) with a residual test; no pair of rows without a common key is ever made.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.operators import ranks

# Letters that names are written with in two ways.
_EXPANDED = {"Ä": "AE", "Ö": "OE", "Ü": "UE", "ß": "SS", "ẞ": "SS"}
_MARKED = "ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝ"
_PLAIN = "AAAAAACEEEEIIIINOOOOOUUUUY"


def upper_name(name: Column) -> Column:
    """Upper case, runs of other characters than letters and digits as one blank."""
    return F.trim(F.regexp_replace(F.upper(name), r"[^\p{L}\p{N}]+", " "))


def expanded(name: Column) -> Column:
    out = upper_name(name)
    for letter, letters in _EXPANDED.items():
        out = F.replace(out, F.lit(letter), F.lit(letters))
    return F.translate(out, _MARKED, _PLAIN)


def name_forms(name: Column) -> Column:
    """Array of the forms of a name without blanks: as written, expanded, without marks."""
    bare = lambda c: F.replace(c, F.lit(" "), F.lit(""))
    return F.array_distinct(F.array(bare(upper_name(name)), bare(expanded(name)), bare(F.translate(upper_name(name), _MARKED, _PLAIN))))


def name_tokens(name: Column) -> Column:
    return F.split(expanded(name), " ")


def name_match(left: Column, right: Column) -> Column:
    """exact, orthography (a common form), prefix (all tokens of the shorter begin the longer), or null."""
    a, b = name_tokens(left), name_tokens(right)
    n = F.least(F.size(a), F.size(b))
    return F.when(upper_name(left) == upper_name(right), "exact").when(F.arrays_overlap(name_forms(left), name_forms(right)), "orthography").when(F.slice(a, F.lit(1), n) == F.slice(b, F.lit(1), n), "prefix")


def match_cardinality(probe: DataFrame, build: DataFrame, keys: list[str], build_id: str) -> DataFrame:
    """probe with n_candidates, status (NO_MATCH, MATCH, AMBIGUOUS) and the only candidate's id (else null)."""
    index = build.groupBy(*keys).agg(F.count_distinct(build_id).alias("n_candidates"), F.min(build_id).alias("__id"))
    out = probe.join(index, keys, "left").withColumn("n_candidates", F.coalesce("n_candidates", F.lit(0).cast("bigint")))
    status = F.when(F.col("n_candidates") == 0, "NO_MATCH").when(F.col("n_candidates") == 1, "MATCH").otherwise("AMBIGUOUS")
    return out.withColumn("status", status).withColumn("candidate", F.when(F.col("n_candidates") == 1, F.col("__id"))).drop("__id")


def demote_shared(df: DataFrame, candidate: str, status: str, review: str = "REVIEW_SHARED") -> DataFrame:
    """Rows whose candidate several rows claim become reviews. The claims are counted by an aggregation, so a popular candidate is no hot window."""
    claims = df.where(F.col(candidate).isNotNull()).groupBy(candidate).agg(F.count(F.lit(1)).alias("__n"))
    out = df.join(claims, candidate, "left")
    return out.withColumn(status, F.when(F.col("__n") > 1, review).otherwise(F.col(status))).drop("__n")


def graded_match(left: DataFrame, right: DataFrame, block: list[str], left_id: str, right_id: str, left_name: str, right_name: str) -> DataFrame:
    """One row for each left id: the strictest grade found, how many right ids have it, the only one (else null), and the status.

    Each grade is an equi-join on the block and what the grade compares: the name, a common form, the first word (then tested for the others). Left ids that a
    stricter grade has settled don't go on, and a rival of the same grade makes the link ambiguous.
    """
    l = left.select(*block, left_id, F.col(left_name).alias("__l")).where(F.col("__l").isNotNull())
    r = right.select(*block, right_id, F.col(right_name).alias("__r")).where(F.col("__r").isNotNull())
    keys = {
        "exact": (F.array(upper_name(F.col("__l"))), F.array(upper_name(F.col("__r")))),
        "orthography": (name_forms(F.col("__l")), name_forms(F.col("__r"))),
        "prefix": (F.slice(name_tokens(F.col("__l")), 1, 1), F.slice(name_tokens(F.col("__r")), 1, 1)),
    }
    graded = None
    for grade, (a, b) in keys.items():
        pairs = l.withColumn("__k", F.explode(a)).join(r.withColumn("__k", F.explode(b)), [*block, "__k"])
        pairs = pairs.where(name_match(F.col("__l"), F.col("__r")) == grade).select(left_id, right_id, F.lit(grade).alias("grade"))
        graded = pairs if graded is None else graded.unionByName(pairs)
        if grade != "prefix":
            l = l.join(pairs.select(left_id).distinct(), left_id, "left_anti")
    rank = F.when(F.col("grade") == "exact", 1).when(F.col("grade") == "orthography", 2).otherwise(3)
    per = graded.groupBy(left_id, rank.alias("__rank")).agg(F.count_distinct(right_id).alias("n"), F.min(right_id).alias("__one"), F.min("grade").alias("grade"))
    top = per.groupBy(left_id).agg(F.min_by(F.struct("n", "__one", "grade"), "__rank").alias("b")).select(left_id, "b.*")
    out = left.select(left_id).distinct().join(top, left_id, "left")
    n = F.coalesce("n", F.lit(0).cast("bigint"))
    status = F.when(n == 0, "NO_MATCH").when(n == 1, "MATCH").otherwise("AMBIGUOUS")
    return out.select(left_id, "grade", n.alias("n_matches"), F.when(n == 1, F.col("__one")).alias(right_id), status.alias("status"))


def date_conflict(a: Column, b: Column) -> Column:
    """Why two dates differ: one_day, day_month_swapped, same_year, different_year; null if equal or unknown."""
    swapped = (F.year(a) == F.year(b)) & (F.month(a) == F.dayofmonth(b)) & (F.dayofmonth(a) == F.month(b))
    return F.when((a == b) | a.isNull() | b.isNull(), None).when(F.abs(F.datediff(a, b)) == 1, "one_day").when(swapped, "day_month_swapped").when(F.year(a) == F.year(b), "same_year").otherwise("different_year")


def partition_ids(target: DataFrame, available: DataFrame, uncertain: DataFrame, key: str) -> DataFrame:
    """key, part for each distinct target key: available, else uncertain, else missing. The three parts are disjoint and complete by construction."""
    flag = lambda df, name: df.select(key).distinct().withColumn(name, F.lit(True))
    rows = target.select(key).distinct().join(flag(available, "__a"), key, "left").join(flag(uncertain, "__u"), key, "left")
    return rows.select(key, F.when(F.col("__a"), "available").when(F.col("__u"), "uncertain").otherwise("missing").alias("part"))


def symmetric_difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """key, side of keys that only one of the two has: one full join of distinct keys."""
    rows = a.select(key).distinct().withColumn("__a", F.lit(1)).join(b.select(key).distinct().withColumn("__b", F.lit(1)), key, "full_outer")
    return rows.where(F.col("__a").isNull() | F.col("__b").isNull()).select(key, F.when(F.col("__b").isNull(), "left").otherwise("right").alias("side"))


def multi_value_index(df: DataFrame, column: str, owner: str, separator: str = ";") -> DataFrame:
    """value, owner: an inverted index of a column of separated values, a row for each owner, so that a popular value is no long row."""
    values = df.select(owner, F.explode(F.split(column, separator)).alias("value")).select(F.trim("value").alias("value"), owner).where("value <> ''")
    return values.distinct()


def index_counts(index: DataFrame) -> DataFrame:
    """value, n_owners and a digest of the owners that doesn't depend on their order."""
    owner = index.columns[1]
    digest = F.conv(F.substring(F.md5(F.col(owner).cast("string").cast("binary")), 1, 8), 16, 10).cast("bigint")
    return index.groupBy("value").agg(F.count(F.lit(1)).alias("n_owners"), F.sum(digest).alias("owners_digest"))


def resolve_in_order(rows: DataFrame, row_id: str, tiers: list[DataFrame], candidate: str) -> DataFrame:
    """The candidate of the first tier that has any for a row: unique, else ambiguous; each tier is a table (row_id, candidate)."""
    all_ = None
    for i, tier in enumerate(tiers):
        part = tier.select(row_id, candidate).withColumn("__tier", F.lit(i))
        all_ = part if all_ is None else all_.unionByName(part)
    per = all_.groupBy(row_id, "__tier").agg(F.count_distinct(candidate).alias("n"), F.min(candidate).alias("__c"))
    top = per.groupBy(row_id).agg(F.min_by(F.struct("n", "__c", "__tier"), "__tier").alias("b")).select(row_id, "b.*")
    out = rows.select(row_id).distinct().join(top, row_id, "left")
    return out.select(row_id, F.when(F.col("n") == 1, F.col("__c")).alias(candidate), F.col("__tier").alias("tier"), F.when(F.col("n").isNull(), "NO_MATCH").when(F.col("n") == 1, "MATCH").otherwise("AMBIGUOUS").alias("status"))


def coherent_groups(df: DataFrame, group: str, attributes: list[str]) -> DataFrame:
    """group, n, coherent: whether a group has at most one known value of every attribute."""
    ok = None
    for a in attributes:
        one = F.coalesce(F.min(a) == F.max(a), F.lit(True))
        ok = one if ok is None else ok & one
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("n"), ok.alias("coherent"))


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """id, component (smallest id reachable) of every id in an edge.

    Rounds of smallest neighbour label and label of label until nothing moves; each is cut by a checkpoint in the shared folder (spark.checkpoint.dir).
    """
    from factloom.sources.work import written

    both = written(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).union(edges.select(F.col(b), F.col(a))).where("u is not null and v is not null").distinct(), "edges")
    labels = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("component")).select(F.col("u").alias("id"), "component", F.lit(True).alias("moved")), "labels")
    while labels.where("moved").limit(1).count():
        old = labels.drop("moved")
        near = both.join(old.withColumnRenamed("id", "v"), "v").groupBy("u").agg(F.min("component").alias("near"))
        new = old.join(near.withColumnRenamed("u", "id"), "id").select("id", F.col("component").alias("was"), F.least("component", "near").alias("component"))
        new = new.join(old.select(F.col("id").alias("component"), F.col("component").alias("up")), "component", "left").withColumn("component", F.coalesce("up", "component"))
        labels = written(new.select("id", "component", (F.col("component") != F.col("was")).alias("moved")), "labels")
    return labels.drop("moved")


def match_any(left: DataFrame, right: DataFrame, left_id: str, right_id: str, key_sets: list[list[str]]) -> DataFrame:
    """Distinct pairs that agree on all columns of any key set: one equi-join for each set, instead of a join on OR. Null keys match nothing.

    The pairs may be far more than the rows, so they aren't made distinct where they can't repeat: a pair of ids with one form of keys each comes from the first set
    on which it agrees. Only pairs with an id of several forms are gathered. The rows are dealt to all shuffle partitions, whose size tells little of their pairs.
    """
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = list(dict.fromkeys(k for keys in key_sets for k in keys))

    def side(df: DataFrame, own_id: str, mark: str) -> DataFrame:
        rows = df.select(own_id, *names).distinct()
        several = rows.groupBy(F.col(own_id).alias("__id")).agg(F.count(F.lit(1)).alias("__k")).where("__k > 1").select("__id", F.lit(True).alias("__m"))
        marked = rows.join(several, F.col(own_id).eqNullSafe(F.col("__id")), "left")
        return marked.select(F.col(own_id).alias(f"{mark}id"), *[F.col(n).alias(f"{mark}{n}") for n in names], F.coalesce("__m", F.lit(False)).alias(f"{mark}m"))

    from factloom.sources.work import written

    a, b = written(side(left, left_id, "__a_"), "left"), written(side(right, right_id, "__b_"), "right")
    same = lambda keys: reduce(lambda x, y: x & y, [F.col(f"__a_{k}") == F.col(f"__b_{k}") for k in keys])

    def pairs(a: DataFrame, b: DataFrame, once: bool) -> DataFrame:
        found = None
        for i, keys in enumerate(key_sets):
            whole = lambda df, mark: df.where(reduce(lambda x, y: x & y, [F.col(f"{mark}{k}").isNotNull() for k in keys])).repartition(parts, *[F.col(f"{mark}{k}") for k in keys])  # noqa: E731, B023
            rows = whole(a, "__a_").join(whole(b, "__b_"), same(keys))
            for earlier in key_sets[:i] if once else []:
                rows = rows.where(~F.coalesce(same(earlier), F.lit(False)))
            rows = rows.select(F.col("__a_id").alias(left_id), F.col("__b_id").alias(right_id))
            found = rows if found is None else found.unionByName(rows)
        return found

    plain = pairs(a.where("NOT __a_m"), b.where("NOT __b_m"), True)
    some = [m for m, df in (("a", a.where("__a_m")), ("b", b.where("__b_m"))) if df.limit(1).count()]
    others = [pairs(a.where("__a_m"), b, False)] * ("a" in some) + [pairs(a.where("NOT __a_m"), b.where("__b_m"), False)] * ("b" in some)
    return reduce(lambda x, y: x.unionByName(y), [plain, *[o.distinct() for o in others]])


def pair_once(left: DataFrame, right: DataFrame, keys: list[str], left_id: str, right_id: str) -> DataFrame:
    """keys, left id, right id: the n-th row of a key on one side goes with the n-th on the other, each is used once, and what is left over has a null partner."""
    nth = lambda df, c: ranks.row_numbers(df.select(*keys, c), keys, [F.col(c)], "__n")
    return nth(left, left_id).join(nth(right, right_id), [*keys, "__n"], "full_outer").select(*keys, left_id, right_id)


def lacking(entities: DataFrame, evidence: DataFrame, keys: list[str], positive: Column) -> DataFrame:
    """Entities without any positive evidence."""
    return entities.join(evidence.where(positive).select(*keys).distinct(), keys, "left_anti")

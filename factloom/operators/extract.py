"""Facts out of texts, nested records and long tables: owned values, rolled-up groups, conserved counts.

An extractor keeps what it rejects with the reason; a value that is not unique is unknown.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.operators import text


def numbered_items(docs: DataFrame, key: str, body: str) -> DataFrame:
    """key, item_no, start, end of items that begin a line with `1.` or `1)`; text before the first item is no item."""
    rows = text.sections(docs, key, body, F.col("line").rlike(r"^\s*\d{1,3}[.)]\s"))
    number = F.regexp_extract("heading", r"^\s*(\d{1,3})[.)]", 1).try_cast("int")
    return rows.where(F.col("heading").isNotNull()).select(key, number.alias("item_no"), "start", "end")


def compound_generic(name: Column, generics: dict[str, str]) -> Column:
    """Sorted generic names of the parts of a combination (`a/b`, `a + b`), joined by ` + `; null if any part is unknown."""
    known = F.create_map(*[F.lit(x) for pair in generics.items() for x in pair])
    parts = F.transform(F.split(name, r"[/+]"), lambda p: F.get(F.map_values(F.map_filter(known, lambda k, v: k == F.lower(F.trim(p)))), F.lit(0)))
    return F.when(~F.exists(parts, lambda p: p.isNull()), F.array_join(F.array_sort(F.array_distinct(parts)), " + "))


def reference_flag(value: Column, low: Column, high: Column) -> Column:
    """LOW, HIGH or NORMAL; null without a value or without the reference that would decide."""
    return F.when(value < low, "LOW").when(value > high, "HIGH").when((value >= low) & (value <= high), "NORMAL")


def header_above(cells: DataFrame, headers: DataFrame, keys: list[str], cell_id: str, y: str, header: str, header_y: str, reach: int) -> DataFrame:
    """cells with the nearest header at most `reach` above them; null if there is none or two differ at that distance.

    The range join is an equi-join on buckets of `reach`, so that a cell meets only two buckets of headers.
    """
    left = cells.select(*keys, cell_id, F.col(y).alias("__y")).withColumn("__b", F.floor(F.col("__y") / reach)).withColumn("__bucket", F.explode(F.array(F.col("__b"), F.col("__b") - 1)))
    right = headers.select(*keys, F.col(header).alias("__h"), F.col(header_y).alias("__hy")).withColumn("__bucket", F.floor(F.col("__hy") / reach))
    gap = F.col("__y") - F.col("__hy")
    near = left.join(right, [*keys, "__bucket"]).where((gap > 0) & (gap <= reach)).groupBy(cell_id, gap.alias("__gap")).agg(F.min("__h").alias("l"), F.max("__h").alias("h"))
    best = near.groupBy(cell_id).agg(F.min_by(F.struct("l", "h"), "__gap").alias("b"))
    return cells.join(best.select(cell_id, F.when(F.col("b.l") == F.col("b.h"), F.col("b.l")).alias("above")), cell_id, "left")


def unseen(rows: DataFrame, seen: DataFrame, line: str, seen_line: str) -> DataFrame:
    """rows whose line, without any blanks, is not among the seen ones; a null line is unseen."""
    squeezed = lambda c: F.regexp_replace(F.col(c), r"\s", "")
    there = seen.select(squeezed(seen_line).alias("__s")).distinct()
    return rows.withColumn("__s", squeezed(line)).join(there, "__s", "left_anti").drop("__s")


def owned_clauses(body: Column, owner: str, finding: str) -> Column:
    """Array of the clauses in which both owner and finding are written; clauses of other owners give nothing."""
    return F.filter(text.clauses(body), lambda c: c.contains(owner) & c.contains(finding))


def owned_date(body: Column, subject: str, blocked: str) -> Column:
    """struct(date, basis): the only day date (d.m.yyyy) of clauses that name the subject and none of the blocked contexts.

    basis: OWNED, SEVERAL (differing dates), BLOCKED (dates in blocked clauses only), NONE. Only OWNED has a date.
    """
    said = F.filter(text.clauses(body), lambda c: c.rlike(subject))
    dates = lambda cs: F.array_compact(F.array_distinct(F.flatten(F.transform(cs, lambda c: F.transform(F.regexp_extract_all(c, F.lit(r"(\d{1,2}\.\d{1,2}\.\d{4})"), F.lit(1)), lambda d: F.try_to_date(d, "d.M.yyyy"))))))
    free, barred = dates(F.filter(said, lambda c: ~c.rlike(blocked))), dates(F.filter(said, lambda c: c.rlike(blocked)))
    basis = F.when(F.size(free) == 1, "OWNED").when(F.size(free) > 1, "SEVERAL").when(F.size(barred) > 0, "BLOCKED").otherwise("NONE")
    return F.struct(F.when(F.size(free) == 1, free[0]).alias("date"), basis.alias("basis"))


def unit_value(line: Column, label: str, factors: dict[str, float]) -> Column:
    """struct(value, status) of `label 12,5 g/L` in the unit whose factor is 1. status: VALID, COMPARATOR (< or >), UNIT (unknown), NONE."""
    pattern = label + r"\s*([<>]?)\s*([0-9]+(?:[.,][0-9]+)?)\s*(\S*)"
    part = lambda g: F.regexp_extract(line, pattern, g)
    factor = None
    for unit, f in factors.items():
        factor = F.when(part(3) == unit, F.lit(f)) if factor is None else factor.when(part(3) == unit, F.lit(f))
    status = F.when(~F.coalesce(line.rlike(pattern), F.lit(False)), "NONE").when(part(1) != "", "COMPARATOR").when(factor.isNull(), "UNIT").otherwise("VALID")
    return F.struct(F.when(status == "VALID", F.replace(part(2), F.lit(","), F.lit(".")).try_cast("double") * factor).alias("value"), status.alias("status"))


def adjacent_scores(docs: DataFrame, key: str, body: str, alias: str, top: int) -> DataFrame:
    """key, place, score, reason of every occurrence of a test's name. A score stands right behind it, as `n` or `n/top`.

    reason: ACCEPTED, RANGE, PERCENT, OUTSIDE (above the top), OTHER_SCALE, NO_NUMBER; only accepted ones have a score.
    """
    hits = F.regexp_extract_all(F.col(body), F.lit(f"({alias}[^A-Za-z\\n]*)"), F.lit(1))
    rows = docs.select(key, F.posexplode(hits).alias("place", "__p"))
    part = lambda g: F.regexp_extract("__p", alias + r"[\s:=]*(\d+)\s*(?:/\s*(\d+))?", g)
    score = part(1).try_cast("int")
    tail = alias + r"[\s:=]*\d+\s*"
    reason = F.when(score.isNull(), "NO_NUMBER").when(F.col("__p").rlike(tail + r"[-–]\s*\d"), "RANGE").when(F.col("__p").rlike(tail + "%"), "PERCENT")
    reason = reason.when((part(2) != "") & (part(2) != str(top)), "OTHER_SCALE").when(score > top, "OUTSIDE").otherwise("ACCEPTED")
    return rows.select(key, "place", F.when(reason == "ACCEPTED", score).alias("score"), reason.alias("reason"))


def head_of_label(label: Column) -> Column:
    """The part of a label before the first comma, semicolon or colon, trimmed."""
    return F.trim(F.split(label, "[,;:]")[0])


def with_taxonomy(df: DataFrame, label: str, paths: dict[str, list[str]]) -> DataFrame:
    """df with a row for each level (level, node) of its label's path; a label without a path keeps its row with nulls. The table of paths is a rule table in the plan."""
    known = F.create_map(*[x for k, v in paths.items() for x in (F.lit(k), F.array(*[F.lit(n) for n in v]))])
    return df.select("*", F.posexplode_outer(F.try_element_at(known, F.col(label))).alias("level", "node"))


def decide_with_reason(rules: list[tuple[str, str, Column]], default: tuple[str, str]) -> Column:
    """struct(status, reason) of the first rule that is true; unknown predicates don't hold."""
    out = F.struct(F.lit(default[0]).alias("status"), F.lit(default[1]).alias("reason"))
    for status, reason, predicate in reversed(rules):
        out = F.when(F.coalesce(predicate, F.lit(False)), F.struct(F.lit(status).alias("status"), F.lit(reason).alias("reason"))).otherwise(out)
    return out


# --- assembling -----------------------------------------------------------------------------------------------------------------


def unique_owner(rows: DataFrame, links: DataFrame, row_id: str, owner: str) -> DataFrame:
    """rows with the only owner their links lead to, and state OWNED, REFERENCE_ONLY (several owners) or UNLINKED. Links are summed up before the join."""
    per = links.where(F.col(owner).isNotNull()).groupBy(row_id).agg(F.min(owner).alias("__l"), F.max(owner).alias("__h"))
    state = F.when(F.col("__l").isNull(), "UNLINKED").when(F.col("__l") == F.col("__h"), "OWNED").otherwise("REFERENCE_ONLY")
    return rows.join(per, row_id, "left").withColumn("state", state).withColumn(owner, F.when(F.col("state") == "OWNED", F.col("__l"))).drop("__l", "__h")


def wide(base: DataFrame, key: str, parts: list[tuple[DataFrame, list[Column]]]) -> DataFrame:
    """base with aggregates of each long table by the key: every table is aggregated first, so each join meets one row a key. Absent keys keep nulls."""
    out = base
    for table, aggregates in parts:
        out = out.join(table.groupBy(key).agg(*aggregates), key, "left")
    return out


def conserved(source: DataFrame, parts: DataFrame, key: str) -> DataFrame:
    """key, state of every key that is not in exactly one part: LOST, REPEATED or INVENTED. One aggregation of both sides."""
    both = source.select(key, F.lit(1).alias("s"), F.lit(0).alias("p")).unionByName(parts.select(key, F.lit(0).alias("s"), F.lit(1).alias("p")))
    per = both.groupBy(key).agg(F.sum("s").alias("s"), F.sum("p").alias("p"))
    state = F.when(F.col("s") == 0, "INVENTED").when(F.col("p") == 0, "LOST").when(F.col("p") > F.col("s"), "REPEATED").when(F.col("p") < F.col("s"), "LOST")
    return per.select(key, state.alias("state")).where(F.col("state").isNotNull())


def exposures(df: DataFrame, group: list[str], sets: list[str], source: str, day: str) -> DataFrame:
    """group, sorted distinct values of each set column, n mentions, n_sources, first and last day. Sets are of short vocabularies."""
    return df.groupBy(*group).agg(*[F.array_join(F.array_sort(F.collect_set(c)), ",").alias(c) for c in sets], F.count(F.lit(1)).alias("n"), F.count_distinct(source).alias("n_sources"), F.min(day).alias("first_day"), F.max(day).alias("last_day"))


def relabelled(df: DataFrame, label: str, canonical: dict[str, str]) -> DataFrame:
    """df with labels replaced by their canonical ones; others stay. Regrouping is then a plain aggregation."""
    out = F.col(label)
    for old, new in canonical.items():
        out = F.when(F.col(label) == old, new).otherwise(out)
    return df.withColumn(label, out)


def rolled_up(df: DataFrame, keys: list[str], flag: Column, order: list[str], status: str) -> DataFrame:
    """keys, any, all (null where only unknown flags), the last segment's status, n."""
    return df.groupBy(*keys).agg(F.bool_or(flag).alias("any"), F.bool_and(flag).alias("all"), F.max_by(status, F.struct(*order)).alias("last_status"), F.count(F.lit(1)).alias("n"))


def ranked_value(df: DataFrame, keys: list[str], rank: str, value: str) -> DataFrame:
    """keys, value, rank, state: the value that all evidence of the best rank (lowest number) agrees on, else null and CONFLICT."""
    per = df.where(F.col(value).isNotNull()).groupBy(*keys, rank).agg(F.min(value).alias("l"), F.max(value).alias("h"))
    best = per.groupBy(*keys).agg(F.min(rank).alias(rank), F.min_by(F.struct("l", "h"), rank).alias("b"))
    same = F.col("b.l") == F.col("b.h")
    return best.select(*keys, rank, F.when(same, F.col("b.l")).alias("value"), F.when(same, "AGREED").otherwise("CONFLICT").alias("state"))


def replay_mismatches(stored: DataFrame, again: dict[str, Column]) -> DataFrame:
    """Stored rows that computing again gives otherwise (null equals null), with the comma-joined names of what differs."""
    differs = F.array_compact(F.array(*[F.when(~F.col(c).eqNullSafe(x), c) for c, x in again.items()]))
    return stored.withColumn("differs", F.array_join(differs, ",")).where(F.col("differs") != "")


def new_flags(found: DataFrame, stored: DataFrame, key: str, state: str, flags: DataFrame) -> DataFrame:
    """key, flag `computed!=stored` to append where both states are known and differ and no flag of that key and text is there; contents are never edited."""
    rows = found.select(key, F.col(state).alias("__f")).join(stored.select(key, F.col(state).alias("__s")), key).where(F.col("__f") != F.col("__s"))
    return rows.select(key, F.concat_ws("!=", "__f", "__s").alias("flag")).distinct().join(flags.select(key, "flag"), [key, "flag"], "left_anti")


def nested(df: DataFrame, key: str, order: list[str], fields: list[str], name: str) -> DataFrame:
    """key and an array of its rows as structs, in order; for keys whose rows fit one value, such as the pages of a document."""
    return df.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct(*order, *[c for c in fields if c not in order]))), lambda r: F.struct(*[r[c].alias(c) for c in fields])).alias(name))


def unnested(df: DataFrame, key: str, name: str) -> DataFrame:
    """key, place (from 0) and the fields of each struct of a nested array; empty arrays give no rows."""
    return df.select(key, F.posexplode(name).alias("place", "__r")).select(key, "place", "__r.*")


def pattern_of(values: Column, rules: list[tuple[str, list[str]]], default: str) -> Column:
    """The first pattern all of whose values are in a set."""
    out = F.lit(default)
    for name, needed in reversed(rules):
        out = F.when(F.size(F.array_intersect(values, F.array(*[F.lit(v) for v in needed]))) == len(needed), name).otherwise(out)
    return out


def queues(df: DataFrame, module: list[str], done: Column, review: Column) -> DataFrame:
    """module, n, n_done, n_review, n_queue (neither done nor in review; unknown predicates don't hold)."""
    d, r = F.coalesce(done, F.lit(False)), F.coalesce(review, F.lit(False))
    return df.groupBy(*module).agg(F.count(F.lit(1)).alias("n"), F.count_if(d).alias("n_done"), F.count_if(r).alias("n_review"), F.count_if(~d & ~r).alias("n_queue"))


def representative(df: DataFrame, keys: list[str], source: str, rank: str) -> DataFrame:
    """keys, the source of the highest rank (of equals the largest source), its rank, and how many sources there are."""
    return df.groupBy(*keys).agg(F.max_by(source, F.struct(rank, source)).alias(source), F.max(rank).alias(rank), F.count_distinct(source).alias("n_sources"))


def projected(parts: list[tuple[DataFrame, str, Column, list[Column], Column]]) -> DataFrame:
    """kind, anchor, value (JSON of the named columns), evidence of facts of several kinds in one long table: (rows, kind, anchor, value columns, evidence) each."""
    out = None
    for rows, kind, anchor, value, evidence in parts:
        own = rows.select(F.lit(kind).alias("kind"), anchor.cast("string").alias("anchor"), F.to_json(F.struct(*value)).alias("value"), evidence.cast("string").alias("evidence"))
        out = own if out is None else out.unionByName(own)
    return out


def slice_geometry(slices: DataFrame, series: list[str], position: list[str], orientation: list[str], tolerance: float = 0.5) -> DataFrame:
    """series, n, step (median distance), n_gaps (distances over the step by more than the tolerance's share), n_repeats (distance 0) of image slices.

    position is a slice's corner, orientation the six cosines of its rows and columns; slices are put in order along the normal of their plane. A series is one
    scan, so its slices are few.
    """
    from pyspark.sql import Window

    r, c, p = [F.col(x) for x in orientation[:3]], [F.col(x) for x in orientation[3:]], [F.col(x) for x in position]
    normal = [r[1] * c[2] - r[2] * c[1], r[2] * c[0] - r[0] * c[2], r[0] * c[1] - r[1] * c[0]]
    along = p[0] * normal[0] + p[1] * normal[1] + p[2] * normal[2]
    rows = slices.select(*series, along.alias("__at"))
    rows = rows.withColumn("__step", F.col("__at") - F.lag("__at").over(Window.partitionBy(*series).orderBy("__at")))
    per = rows.groupBy(*series).agg(F.count(F.lit(1)).alias("n"), F.median(F.when(F.col("__step") > 1e-6, F.col("__step"))).alias("step"), F.collect_list("__step").alias("__steps"))
    wide = F.size(F.filter("__steps", lambda s: s > F.col("step") * (1 + tolerance)))
    return per.select(*series, "n", F.round("step", 6).alias("step"), wide.alias("n_gaps"), F.size(F.filter("__steps", lambda s: F.abs(s) <= 1e-6)).alias("n_repeats"))

"""Text operators: lines, sections, rule classification, assertions, mentions, copies.

Rules are data: lists of (label, pattern) that become one column expression, so that texts are read once and nothing is joined to them.
Patterns use explicit classes that Java and RE2 read alike.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.functions.offsets import located
from pyspark.sql import types as T


def normalized(text: Column) -> Column:
    """Lower case, runs of blanks as one, ends trimmed; null stays null."""
    return F.lower(F.trim(F.regexp_replace(text, r"[ \t\n\r\f]+", " ")))


def signature(text: Column) -> Column:
    """Shape of a line: digits as #, other non-letters dropped, lower case."""
    return F.lower(F.regexp_replace(F.regexp_replace(text, "[0-9]", "#"), r"[^A-Za-zÄÖÜäöüßÀ-ÿ#]", ""))


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("line", T.StringType()), T.StructField("start", T.LongType())])))
def _with_starts(texts: pd.Series) -> pd.Series:
    def cut(t: str | None) -> list[dict] | None:
        if t is None:
            return None
        out, at = [], 0
        for line in t.split("\n"):
            out.append({"line": line, "start": at})
            at += len(line) + 1
        return out

    return texts.map(cut)


def lines(docs: DataFrame, key: str, text: str, *more: Column) -> DataFrame:
    """key, line_no (from 0), line, start: every line with the code point offset it begins at, and further columns of the text. Nothing is shuffled."""
    names = docs.select(key, *more).columns
    return docs.select(key, *more, F.posexplode(_with_starts(F.col(text))).alias("line_no", "l")).select(*names, "line_no", "l.line", "l.start")


def noise_lines(docs: DataFrame, key: str, text: str, least: int) -> DataFrame:
    """line, n_docs of trimmed non-empty lines that at least `least` documents hold. Lines are made distinct inside a document before they are counted."""
    own = docs.select(key, F.explode(F.array_distinct(F.transform(F.split(text, "\n"), lambda x: F.trim(x)))).alias("line")).where("line <> ''")
    return own.groupBy("line").agg(F.count(F.lit(1)).alias("n_docs")).where(F.col("n_docs") >= least)


def without_noise(docs: DataFrame, key: str, text: str, noise: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Kept and excluded lines, so that nothing is lost: two outputs of one marked table."""
    own = docs.select(key, F.posexplode(F.split(text, "\n")).alias("line_no", "line"))
    marked = own.withColumn("__t", F.trim("line")).join(noise.select(F.col("line").alias("__t"), F.lit(True).alias("__noise")), "__t", "left").drop("__t")
    return marked.where("__noise is null").drop("__noise"), marked.where("__noise").drop("__noise")


def sections(docs: DataFrame, key: str, text: str, is_heading: Column) -> DataFrame:
    """key, section_no, start, end, heading: spans from a heading line to the next; together they cover the text without gap or overlap.

    is_heading is a predicate on the columns line and line_no. What comes before the first heading is a section of its own, without heading.
    """
    rows = lines(docs, key, text, F.length(text).alias("__n")).withColumn("__h", is_heading)
    heads = rows.where(F.col("__h") | (F.col("line_no") == 0)).select(key, "__n", "line_no", "start", F.when(F.col("__h"), F.col("line")).alias("heading"))
    w = Window.partitionBy(key).orderBy("line_no")  # of headings only
    spans = heads.withColumn("section_no", F.row_number().over(w)).withColumn("__next", F.lead("start").over(w))
    return spans.select(key, "section_no", F.col("start").cast("bigint").alias("start"), F.coalesce("__next", "__n").cast("bigint").alias("end"), "heading")


def labels(text: Column, rules: list[tuple[str, str]]) -> Column:
    """Array of the labels whose pattern is found, in rule order."""
    return F.array_compact(F.array(*[F.when(text.rlike(p), name) for name, p in rules]))


def first_label(text: Column, rules: list[tuple[str, str]], default: str | None = None) -> Column:
    """The first label whose pattern is found."""
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for name, p in rules:
        out = out.when(text.rlike(p), name)
    return out.otherwise(F.lit(default))


def only_label(text: Column, rules: list[tuple[str, str]], default: str = "unknown") -> Column:
    """The label if exactly one pattern is found, else the default."""
    found = labels(text, rules)
    return F.when(F.size(found) == 1, F.get(found, F.lit(0))).otherwise(default)


def heading_label(line: Column, rules: list[tuple[str, str, str]], longest: int = 120) -> Column:
    """Label of a heading line by rules (label, kind, pattern) of kind EXACT, PREFIX or REGEX; of several the longest pattern wins. Prose has none."""
    t = normalized(line)
    hits = []
    for name, kind, p in rules:
        test = t == p.lower() if kind == "EXACT" else F.startswith(t, F.lit(p.lower())) if kind == "PREFIX" else t.rlike(p)
        hits.append(F.when(test, F.struct(F.lit(len(p)).alias("n"), F.lit(name).alias("label"))))
    prose = (F.length(t) > longest) | t.rlike(r"[.!?] [a-z]")
    return F.when(~prose, F.array_max(F.array_compact(F.array(*hits)))["label"])


#: Assertion cascade, strictest first: (state, pattern) on the normalized clause around a concept.
ASSERTIONS = [
    ("NEGATED", r"\b(no|not|without|never|kein|keine|ohne|sans|pas|sin|ning[uú]n)\b"),
    ("CONDITIONAL", r"\b(if|unless|falls|wenn|wäre|si)\b"),
    ("DIFFERENTIAL", r"\b(versus|vs|differential|rule out|ausschluss)\b"),
    ("UNCERTAIN", r"\b(possible|possibly|probable|suspected|verdacht|fraglich|peut|posible)\b"),
]


def assertion(clause: Column, concept: str, cascade: list[tuple[str, str]] = ASSERTIONS) -> Column:
    """State of a concept in a clause: null if it isn't named, else the first state of the cascade, else ESTABLISHED."""
    t = normalized(clause)
    out = F.when(~t.rlike(concept), F.lit(None).cast("string"))
    for state, p in cascade:
        out = out.when(t.rlike(p), state)
    return out.otherwise("ESTABLISHED")


def clauses(text: Column) -> Column:
    """Array of clauses: cut after sentence ends, semicolons and line ends."""
    return F.filter(F.transform(F.split(text, r"[.;!?]+[ \n]|\n"), lambda c: F.trim(c)), lambda c: c != "")


def mentions(docs: DataFrame, key: str, text: str, concepts: dict[str, str]) -> DataFrame:
    """key, concept, n_mentions for each concept found: one pass over each text, a row for each hit."""
    counts = F.array(*[F.struct(F.lit(c).alias("concept"), F.regexp_count(text, F.lit(p)).alias("n_mentions")) for c, p in concepts.items()])
    return docs.select(key, F.explode(F.filter(counts, lambda s: s["n_mentions"] > 0)).alias("m")).select(key, "m.concept", "m.n_mentions")


def mention_states(docs: DataFrame, key: str, text: str, concepts: dict[str, str]) -> DataFrame:
    """key, concept, state, n: the assertion states of a concept's clauses, counted."""
    own = docs.select(key, F.explode(clauses(F.col(text))).alias("clause"))
    states = F.array(*[F.struct(F.lit(c).alias("concept"), assertion(F.col("clause"), p).alias("state")) for c, p in concepts.items()])
    rows = own.select(key, F.explode(F.filter(states, lambda s: s["state"].isNotNull())).alias("s")).select(key, "s.*")
    return rows.groupBy(key, "concept", "state").agg(F.count(F.lit(1)).alias("n"))


def labelled_value(text: Column, label: str, value: str = r"(-?[0-9]+(?:[.,][0-9]+)?)") -> Column:
    """The number after a label, decimal comma or point; null if there is none."""
    got = F.regexp_extract(text, label + r"[ :=]*" + value, 1)
    return F.when(got != "", F.replace(got, F.lit(","), F.lit(".")).try_cast("double"))


def unanimous(values: Column) -> Column:
    """The only distinct non-null value of an array, else null."""
    distinct = F.array_distinct(F.array_compact(values))
    return F.when(F.size(distinct) == 1, F.get(distinct, F.lit(0)))


def fingerprint(text: Column) -> Column:
    """SHA-256 of the normalized text."""
    return F.sha2(F.coalesce(normalized(text), F.lit("")), 256)


def copy_groups(docs: DataFrame, key: str, text: str) -> DataFrame:
    """fingerprint, representative (smallest key), n_copies: documents that are equal when normalized."""
    return docs.select(key, fingerprint(F.col(text)).alias("fingerprint")).groupBy("fingerprint").agg(F.min(key).alias("representative"), F.count(F.lit(1)).alias("n_copies"))


def keep_first(df: DataFrame, keys: list[Column], order: list[str]) -> DataFrame:
    """The first row (by order) of each normalized key; one aggregation instead of a window, so copies are dropped before the shuffle."""
    cols = df.columns
    named = [k.alias(f"__k{i}") for i, k in enumerate(keys)]
    first = F.min_by(F.struct(*cols), F.struct(*order)).alias("r")
    return df.groupBy(*named).agg(first).select("r.*")


def inventory(df: DataFrame, keys: list[str], day: str, text: str) -> DataFrame:
    """Exams of a day: texts nested in the longest one are its copies (exact count 1); otherwise the count is unknown and 1 is the lower bound.

    Distinct normalized texts of a day are few; the day is the bound of what one group gathers.
    """
    rows = df.select(*keys, F.to_date(day).alias("day"), normalized(F.col(text)).alias("__t")).distinct()
    longest = rows.groupBy(*keys, "day").agg(F.max_by("__t", F.struct(F.length("__t"), F.col("__t"))).alias("__long"))
    nested = rows.join(longest, [*keys, "day"]).groupBy(*keys, "day").agg(F.bool_and(F.contains("__long", "__t")).alias("exact"), F.count(F.lit(1)).alias("n_texts"))
    return nested.groupBy(*keys).agg(F.when(F.bool_and("exact"), F.count(F.lit(1))).alias("exact_count"), F.count(F.lit(1)).alias("lower_bound"), F.sum("n_texts").alias("n_texts"))


def running_label(rows: DataFrame, key: str, order: str, label: Column) -> DataFrame:
    """rows with `context`: the last label seen up to each row of its document."""
    w = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("context", F.last(label, ignorenulls=True).over(w))


def locate_quote(quote: Column, text: Column) -> Column:
    """struct(start, end) of a quote's place in a text as it stands, blanks and Unicode forms aside (functions.offsets); null if it isn't there or there twice."""
    at = located(text, quote, 1)
    return F.when(at["n_places"] == 1, F.struct(at["start"].alias("start"), at["end"].alias("end")))


def longest_alias(name: Column, aliases: list[tuple[str, str]]) -> Column:
    """Code of the longest alias that begins a name as whole words; AMBIGUOUS if aliases of that length differ in code, null without any."""
    t = normalized(name)
    hits = F.array_compact(F.array(*[F.when((t == a.lower()) | F.startswith(t, F.lit(a.lower() + " ")), F.struct(F.lit(len(a)).alias("n"), F.lit(code).alias("code"))) for a, code in aliases]))
    top = F.array_max(F.transform(hits, lambda h: h["n"]))
    codes = F.array_distinct(F.transform(F.filter(hits, lambda h: h["n"] == top), lambda h: h["code"]))
    return F.when(F.size(codes) == 1, F.get(codes, F.lit(0))).when(F.size(codes) > 1, "AMBIGUOUS")


def dosage(text: Column) -> Column:
    """struct(strength, unit, schedule, as_needed) of a product line such as `12,5 mg 1-0-1 if needed`; parts not found are null."""
    number = r"([0-9]+(?:[.,][0-9]+)?) ?(mg|g|ml|%)"
    part = lambda p, g: F.nullif(F.regexp_extract(text, p, g), F.lit(""))
    return F.struct(F.replace(part(number, 1), F.lit(","), F.lit(".")).try_cast("double").alias("strength"), part(number, 2).alias("unit"), part(r"([0-9](?:-[0-9]){2,3})", 1).alias("schedule"), text.rlike("if needed|bei Bedarf").alias("as_needed"))


def nearest(x: Column, centers: list[tuple[str, float]], margin: float) -> Column:
    """struct(label, ambiguous): the label of the nearest center (the first of equals), and whether the second nearest is less than `margin` farther."""
    ranked = F.array_sort(F.array(*[F.struct(F.abs(x - c).alias("d"), F.lit(i).alias("i"), F.lit(label).alias("label")) for i, (label, c) in enumerate(centers)]))
    return F.when(x.isNotNull(), F.struct(ranked[0]["label"].alias("label"), (ranked[1]["d"] - ranked[0]["d"] < margin).alias("ambiguous")))


def bind_items(items: DataFrame, units: DataFrame, keys: list[str], item_id: str, item: str, unit_id: str, unit: str) -> DataFrame:
    """item_id, the only unit of its section whose text holds the item's or is held by it, and state MAPPED, AMBIGUOUS or UNMAPPED; every item has a row."""
    pairs = items.select(*keys, item_id, normalized(F.col(item)).alias("__i")).join(units.select(*keys, unit_id, normalized(F.col(unit)).alias("__u")), keys)
    pairs = pairs.where((F.length("__i") > 0) & (F.length("__u") > 0) & (F.contains("__i", "__u") | F.contains("__u", "__i")))
    found = pairs.groupBy(item_id).agg(F.count_distinct(unit_id).alias("__n"), F.min(unit_id).alias("__one"))
    state = F.when(F.col("__n") == 1, "MAPPED").when(F.col("__n") > 1, "AMBIGUOUS").otherwise("UNMAPPED")
    return items.select(item_id).join(found, item_id, "left").select(item_id, F.when(F.col("__n") == 1, F.col("__one")).alias(unit_id), state.alias("state"))

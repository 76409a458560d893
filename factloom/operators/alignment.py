"""Alignment of two versions of the units of a place (lines of a document, events of a section, ...) by what they say and where they stand.

Units with one set of words are one class, so repeated units make no pairs among each other. Classes meet in two ways: over an inverted index of words that holds of each
class only the rarest words of its place, as many as two sets that are similar enough must share one of, and over the overlap of their spans, dealt to buckets of
characters. What meets is checked on the sets; then each class's best partner decides.

Places that lie in one row with both versions (align_rows) are compared inside the row; of them only pairs of units that are partners are shuffled, without their texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.sources.work import written

WORD = r"[\p{L}\p{N}_]{4,}"


def _members(units: DataFrame, place: list[str], unit: str, text: str, start: str, end: str, word: str) -> DataFrame:
    words = F.array_sort(F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(word), 0)))
    rows = units.select(*place, F.col(unit).alias("__id"), F.col(start).alias("__a"), F.col(end).alias("__z"), words.alias("__w"))
    return rows.withColumn("__c", F.unhex(F.sha2(F.array_join("__w", " "), 256)))


def _classes(members: DataFrame, place: list[str]) -> DataFrame:
    return members.groupBy(*place, "__c").agg(F.min("__id").alias("__id"), F.count(F.lit(1)).alias("__k"), F.any_value("__w").alias("__w"))


def _same(names: list[str], a: str = "a", b: str = "b") -> Column:
    same = F.lit(True)
    for n in names:
        same = same & F.col(f"{a}.{n}").eqNullSafe(F.col(f"{b}.{n}"))
    return same


def _prefixes(classes: DataFrame, frequencies: DataFrame, place: list[str], least: tuple[int, int]) -> DataFrame:
    """place, __c, __n (words of the class), __t: its rarest words, of which any set of enough similarity shares one."""
    rows = classes.select(*place, "__c", F.size("__w").alias("__n"), F.explode("__w").alias("__t"))
    known = rows.alias("a").join(frequencies.alias("b"), _same([*place, "__t"])).select("a.*", "b.__f")
    rank = F.row_number().over(Window.partitionBy(*place, "__c").orderBy("__f", "__t"))
    needed = F.ceil(F.col("__n") * least[0] / F.lit(least[1]))
    return known.withColumn("__r", rank).where(F.col("__r") <= F.col("__n") - needed + 1).drop("__r", "__f")


def _placed(members: DataFrame, place: list[str], width: int) -> DataFrame:
    buckets = F.sequence(F.floor(F.col("__a") / width), F.floor((F.greatest("__z", F.col("__a") + 1) - 1) / width))
    return members.where("__z > __a").select(*place, "__c", "__a", "__z", F.explode(buckets).alias("__b"))


def pairs(old: DataFrame, new: DataFrame, place: list[str], unit: str, text: str, start: str, end: str, *, least: tuple[int, int] = (1, 2), word: str = WORD, width: int = 512) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Classes of old, classes of new, and the pairs of them: place, __o, __n (classes), shared, n_union, overlap.

    A pair shares its place and has a Jaccard similarity of words of `least` (numerator, denominator) or more, or a member of each whose spans overlap.
    """
    a, b = (_members(x, place, unit, text, start, end, word) for x in (old, new))
    olds, news = written(_classes(a, place), "classes"), written(_classes(b, place), "classes")
    each = lambda c: c.select(*place, F.explode("__w").alias("__t"))
    often = each(olds).unionByName(each(news)).groupBy(*place, "__t").agg(F.count(F.lit(1)).alias("__f"))
    p, q = _prefixes(olds, often, place, least), _prefixes(news, often, place, least)
    lengths = (F.col("a.__n") * least[1] >= F.col("b.__n") * least[0]) & (F.col("b.__n") * least[1] >= F.col("a.__n") * least[0])
    meeting = [F.col(f"a.{c}") for c in place] + [F.col("a.__c").alias("__o"), F.col("b.__c").alias("__n")]
    alike = p.alias("a").join(q.alias("b"), _same([*place, "__t"]) & lengths).select(*meeting).distinct()
    spans = _same([*place, "__b"]) & (F.col("a.__a") < F.col("b.__z")) & (F.col("b.__a") < F.col("a.__z"))
    near = _placed(a, place, width).alias("a").join(_placed(b, place, width).alias("b"), spans).select(*meeting).distinct()
    met = alike.withColumn("__v", F.lit(False)).unionByName(near.withColumn("__v", F.lit(True))).groupBy(*place, "__o", "__n").agg(F.max("__v").alias("overlap"))
    known = met.alias("m").join(olds.alias("a"), _same(place, "m", "a") & (F.col("m.__o") == F.col("a.__c")))
    known = known.select("m.*", F.col("a.__w").alias("__wa")).alias("m").join(news.alias("b"), _same(place, "m", "b") & (F.col("m.__n") == F.col("b.__c"))).select("m.*", F.col("b.__w").alias("__wb"))
    shared = F.size(F.array_intersect("__wa", "__wb"))
    found = known.withColumn("shared", shared).withColumn("n_union", F.size("__wa") + F.size("__wb") - F.col("shared")).drop("__wa", "__wb")
    found = found.where(F.col("overlap") | ((F.col("shared") > 0) & (F.col("shared") * least[1] >= F.col("n_union") * least[0])))
    return olds, news, written(found, "pairs")


def _best(found: DataFrame, place: list[str], mine: str, other: str, out: str) -> DataFrame:
    """place, mine, out: the partner that is better than all others, null where several are best."""
    score = F.struct((F.col("shared") / F.greatest("n_union", F.lit(1))).alias("s"), F.col("overlap").alias("v"))
    rows = found.select(*place, mine, other, score.alias("__s"))
    top = rows.groupBy(*place, mine).agg(F.max("__s").alias("__s"))
    ties = rows.alias("a").join(top.alias("b"), _same([*place, mine, "__s"])).groupBy(*[F.col(f"a.{c}").alias(c) for c in (*place, mine)]).agg(F.count(F.lit(1)).alias("__k"), F.min(f"a.{other}").alias("__one"))
    return ties.select(*place, mine, F.when(F.col("__k") == 1, F.col("__one")).alias(out))


def align(old: DataFrame, new: DataFrame, place: list[str], unit: str, text: str, start: str, end: str, *, least: tuple[int, int] = (1, 2), word: str = WORD, width: int = 512) -> DataFrame:
    """place, old_unit, new_unit (smallest of their classes), n_old, n_new, shared, n_union, state of every class of both versions.

    ALIGNED: each is the other's only best partner (one to one). AMBIGUOUS: there are partners, but no such one. REMOVED, ADDED: no partner. Units without a
    word of `word` are alike in nothing and align by their spans only; a null text is empty.
    """
    olds, news, found = pairs(old, new, place, unit, text, start, end, least=least, word=word, width=width)
    forth, back = _best(found, place, "__o", "__n", "__best"), _best(found, place, "__n", "__o", "__best")
    mutual = forth.alias("a").join(back.alias("b"), _same(place) & (F.col("a.__best") == F.col("b.__n")) & (F.col("b.__best") == F.col("a.__o")))
    chosen = mutual.select(*[F.col(f"a.{c}").alias(c) for c in place], F.col("a.__o").alias("__o"), F.col("b.__n").alias("__n"))
    chosen = chosen.alias("a").join(found.alias("b"), _same([*place, "__o", "__n"])).select("a.*", "b.shared", "b.n_union")

    def side(classes: DataFrame, key: str, met: DataFrame, lone: str, names: tuple[str, str]) -> DataFrame:
        rows = classes.select(*place, F.col("__c").alias(key), F.col("__id").alias(names[0]), F.col("__k").alias(names[1]))
        rows = rows.alias("a").join(met.select(*place, key).distinct().alias("b"), _same([*place, key]), "left").select("a.*", F.col(f"b.{key}").isNotNull().alias("__met"))
        return rows.withColumn("__state", F.when(F.col("__met"), "AMBIGUOUS").otherwise(lone)).drop("__met")

    left, right = side(olds, "__o", found, "REMOVED", ("old_unit", "n_old")), side(news, "__n", found, "ADDED", ("new_unit", "n_new"))
    left = left.alias("a").join(chosen.alias("b"), _same([*place, "__o"]), "left").select("a.*", "b.__n", "b.shared", "b.n_union")
    taken = chosen.select(*place, "__n")
    both = left.where("__n is not null").alias("a").join(right.alias("b"), _same([*place, "__n"])).select(
        *[F.col(f"a.{c}").alias(c) for c in place], "a.old_unit", "b.new_unit", "a.n_old", "b.n_new", "a.shared", "a.n_union", F.lit("ALIGNED").alias("state")
    )
    lone = left.where("__n is null").select(*place, "old_unit", "n_old", F.col("__state").alias("state"))
    fresh = right.alias("a").join(taken.alias("b"), _same([*place, "__n"]), "left_anti").select(*place, "new_unit", "n_new", F.col("__state").alias("state"))
    return both.unionByName(lone, allowMissingColumns=True).unionByName(fresh, allowMissingColumns=True)


def align_rows(rows: DataFrame, place: list[str], old: str, new: str, *, least: tuple[int, int] = (1, 2), word: str = WORD) -> DataFrame:
    """What align() gives, of rows that hold a place each with its units in arrays old and new of struct<unit, text, start, end>.

    Each class meets each of the other version of its row, so rows of very many units are for align().
    """

    def classes(c: str) -> Column:
        words = lambda u: F.array_sort(F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(u["text"], F.lit(""))), F.lit(word), 0)))
        return F.transform(c, lambda u: F.struct(u["unit"].alias("id"), u["start"].alias("a"), u["end"].alias("z"), words(u).alias("w")))

    def grouped(c: str) -> Column:
        own = lambda w: F.filter(c, lambda u: u["w"] == w)
        spans = lambda m: F.transform(F.filter(m, lambda u: u["z"] > u["a"]), lambda u: F.struct(u["a"], u["z"]))
        sets = F.transform(F.array_distinct(F.transform(c, lambda u: u["w"])), lambda w: F.struct(w.alias("w"), own(w).alias("m")))
        # a bit for each word: each bit that only one of two sets has stands for a word at least that the other lacks
        bits = lambda w: F.aggregate(w, F.lit(0).cast("bigint"), lambda b, x: b.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(F.xxhash64(x), F.lit(64)).cast("int"))))
        return F.transform(sets, lambda s: F.struct(F.array_min(s["m"]["id"]).alias("id"), F.size(s["m"]).cast("bigint").alias("k"), s["w"].alias("w"), F.size(s["w"]).alias("len"), bits(s["w"]).alias("bits"), spans(s["m"]).alias("spans")))

    overlap = lambda o, n: F.exists(o["spans"], lambda s: F.exists(n["spans"], lambda t: (s["a"] < t["z"]) & (t["a"] < s["z"])))
    lacks = lambda a, b: F.bit_count(a["bits"].bitwiseAND(F.bitwise_not(b["bits"])))
    enough = lambda shared, both: shared * (least[0] + least[1]) >= both * least[0]

    def possible(o: Column, n: Column) -> Column:
        return enough(F.least(o["len"] - lacks(o, n), n["len"] - lacks(n, o)), o["len"] + n["len"]) | overlap(o, n)

    def pair(o: Column, n: Column) -> Column:
        met = F.struct(n["id"].alias("n"), n["k"].alias("kn"), (o["len"] + n["len"]).alias("both"), overlap(o, n).alias("overlap"))
        return F.struct(met.alias("p"), F.size(F.array_intersect(o["w"], n["w"])).alias("shared"))

    alike = lambda x: x["p"]["overlap"] | ((x["shared"] > 0) & enough(x["shared"], x["p"]["both"]))
    held = rows.select(*place, classes(old).alias("__o"), classes(new).alias("__n")).select(*place, grouped("__o").alias("__o"), grouped("__n").alias("__n"))
    found = F.transform("__o", lambda o: F.struct(o["id"].alias("o"), o["k"].alias("ko"), F.filter(F.transform(F.filter("__n", lambda n: possible(o, n)), lambda n: pair(o, n)), alike).alias("ps")))
    held = held.select(*place, found.alias("__o"), F.transform("__n", lambda n: F.struct(n["id"].alias("n"), n["k"].alias("kn"))).alias("__n"))
    # a row for each pair, and one for each class of its own
    of = lambda o, ko, n, kn, both=None, shared=None, overlap=None: F.struct(*[(F.lit(None).cast(t) if c is None else c).alias(x) for c, x, t in ((o, "o", "bigint"), (ko, "ko", "bigint"), (n, "n", "bigint"), (kn, "kn", "bigint"), (both, "both", "int"), (shared, "shared", "int"), (overlap, "overlap", "boolean"))])
    pairs_of = lambda x: F.concat(F.array(of(x["o"], x["ko"], None, None)), F.transform(x["ps"], lambda y: of(x["o"], x["ko"], y["p"]["n"], y["p"]["kn"], y["p"]["both"], y["shared"], y["p"]["overlap"])))
    each = F.concat(F.flatten(F.transform("__o", pairs_of)), F.transform("__n", lambda n: of(None, None, n["n"], n["kn"])))
    flat = held.select(*place, F.explode(each).alias("e")).select(*place, "e.*").withColumn("n_union", F.col("both") - F.col("shared")).drop("both")
    # from here on the rows of a place lie together, so nothing below is shuffled again
    flat = flat.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *place).withColumn("__s", F.col("shared") / F.greatest("n_union", F.lit(1)))
    for c in ("o", "n"):
        rank = F.rank().over(Window.partitionBy(*place, c).orderBy(F.desc_nulls_last("__s"), F.desc_nulls_last("overlap")))
        flat = flat.withColumn("__r", rank).withColumn(f"__one_{c}", (F.col("__r") == 1) & (F.sum((F.col("__r") == 1).cast("int")).over(Window.partitionBy(*place, c)) == 1))
    met = F.col("o").isNotNull() & F.col("n").isNotNull()
    mine = F.when(met & F.col("__one_o") & F.col("__one_n"), F.struct("n", "kn", "shared", "n_union"))
    sides = F.array(F.struct(F.lit(0).alias("v"), F.col("o").alias("id"), F.col("ko").alias("k")), F.struct(F.lit(1).alias("v"), F.col("n").alias("id"), F.col("kn").alias("k")))
    own = flat.select(*place, met.alias("met"), mine.alias("mine"), F.explode(sides).alias("x")).where("x.id IS NOT NULL")
    own = own.groupBy(*place, F.col("x.v").alias("v"), F.col("x.id").alias("id")).agg(F.max("x.k").alias("k"), F.max("met").alias("met"), F.max("mine").alias("mine")).where("v = 0 OR mine IS NULL")
    state = F.when(F.col("mine").isNotNull(), "ALIGNED").when(F.col("met"), "AMBIGUOUS").when(F.col("v") == 0, "REMOVED").otherwise("ADDED")
    side = lambda v, c: F.when(F.col("v") == v, F.col(c))
    return own.select(
        *place, side(0, "id").alias("old_unit"), F.coalesce(side(1, "id"), "mine.n").alias("new_unit"), side(0, "k").alias("n_old"), F.coalesce(side(1, "k"), "mine.kn").alias("n_new"), "mine.shared", "mine.n_union", state.alias("state")
    )

"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text is cut into pieces (a line, or a part of it of at most PIECE_WORDS words), and each distinct piece's digest (40 bits, with 24 check bits) is
added to three cells of a sketch: count, and xor of digests. A fingerprint is the sketch with CELLS_A_PIECE to twice as many cells a piece, in steps of powers of
two, so that it can be folded to any smaller step. The fingerprints of two versions are folded to one size and subtracted cell by cell; common pieces
vanish, so that a small edit leaves three cells for each piece it changes, and peeling (cells with one digest left give it away, which frees other
cells) recovers the digests that differ. Where peeling gets stuck, for more differs than the fingerprints hold, larger sketches of the
digests are made, sized for the pieces of both, then larger ones; should the last fail too, the digests themselves are compared. Likeness is the Jaccard
similarity that the recovered difference implies. Built from SQL functions only; cells without a piece are not stored.

Defined results: a null text is empty; two empty texts have likeness 1; repeated rows have a fingerprint each, equal ids are ordered by text;
null ids (and the smallest long) come last in descending order and are returned as null; of an only document the next is itself; an empty table gives an empty result. Extra columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factloom.llm.common import documents, written

PIECE_WORDS = 24
#: Cells of the smallest sketch's three tables; least cells of a fingerprint for each piece.
SMALLEST, CELLS_A_PIECE = 8, 1.5
#: Sizes of the sketches that `difference` compares one after the other, as shares of the pieces of both texts; peeling rounds.
FIRST_SHARE, GROWTH, ATTEMPTS, ROUNDS = 2.0, 3, 3, 40
#: Peeling steps over one table of cells each that are taken before larger sketches are made.
STEPS = 12
#: Documents of a range of ids.
RANGE_ROWS = 20_000
_CELL = "array<struct<at:int,n:int,key:bigint>>"
_PIECE = rf"(?:\S+[\x20\t]+){{0,{PIECE_WORDS - 1}}}\S+"
_HIGH = -(1 << 24)


def bound(value: Column, use) -> Column:
    """use(value) with value computed once."""
    return F.transform(F.array(value), use)[0]


def digests(text: Column) -> Column:
    """Sorted distinct digests of a text's pieces."""
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(_PIECE), F.lit(0)), lambda p: _checked(F.xxhash64(p).bitwiseAND(F.lit(_HIGH))))))


def _checked(digest: Column) -> Column:
    """A 40-bit digest with its 24 check bits below it."""
    return digest.bitwiseXOR(F.shiftrightunsigned(F.xxhash64(digest), 40))


def _entries(key: Column, n: Column, third: Column) -> Column:
    # three places from separate bits of the digest, which is a hash itself
    cell = lambda j: F.struct((F.pmod(F.shiftright(key, 13 * j + 11), third).cast("int") + third * j).alias("at"), n.alias("n"), key.alias("key"))
    return F.array(*[cell(j) for j in range(3)])


def _merged(cells: Column) -> Column:
    """Cells with equal places added up, empty ones left out, in order of place."""
    none = F.struct(F.lit(-1).alias("at"), F.lit(0).alias("n"), F.lit(0).cast("bigint").alias("key"))
    start = F.struct(F.array().cast(_CELL).alias("done"), none.alias("open"))
    kept = lambda s: F.when(s["open"]["key"] == 0, s["done"]).otherwise(F.concat(s["done"], F.array(s["open"])))

    def step(s: Column, c: Column) -> Column:
        o = s["open"]
        both = F.struct(c["at"].alias("at"), (o["n"] + c["n"]).alias("n"), o["key"].bitwiseXOR(c["key"]).alias("key"))
        return F.when(o["at"] == c["at"], F.struct(s["done"].alias("done"), both.alias("open"))).otherwise(F.struct(kept(s).alias("done"), c.alias("open")))

    return F.aggregate(F.array_sort(cells), start, step, kept)


def sketch(keys: Column, cells: Column) -> Column:
    """The non-empty cells of the sketch of these digests; `cells` is a multiple of three."""
    third = (cells / 3).cast("int")
    return _merged(F.flatten(F.transform(keys, lambda k: _entries(k, F.lit(1), third))))


def subtract(left: Column, right: Column) -> Column:
    minus = F.transform(right, lambda c: F.struct(c["at"].alias("at"), (-c["n"]).alias("n"), c["key"].alias("key")))
    return _merged(F.concat(left, minus))


def peel(difference: Column, cells: Column) -> Column:
    """The digests in a difference (only left: n 1; only right: n -1) as an array of key and n; null if peeling gets stuck."""
    third = (cells / 3).cast("int")
    found_type = "array<struct<key:bigint,n:int>>"
    start = F.struct(difference.alias("left"), F.array().cast(found_type).alias("found"))
    single = lambda c: (F.abs(c["n"]) == 1) & (_checked(c["key"].bitwiseAND(F.lit(_HIGH))) == c["key"])

    def round_(s: Column) -> Column:
        pure = F.array_distinct(F.transform(F.filter(s["left"], single), lambda c: F.struct(c["key"].alias("key"), c["n"].alias("n"))))
        taken = lambda p: _merged(F.concat(s["left"], F.flatten(F.transform(p, lambda x: _entries(x["key"], -x["n"], third)))))
        return bound(pure, lambda p: F.when(F.size(p) == 0, s).otherwise(F.struct(taken(p).alias("left"), F.concat(s["found"], p).alias("found"))))

    step = lambda s, _: F.when(F.size(s["left"]) == 0, s).otherwise(round_(s))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda s: F.when(F.size(s["left"]) == 0, s["found"]))


def difference(left: Column, right: Column, first: int = 0) -> Column:
    """Number of digests that differ between two texts' digests: recovered by peeling, with larger sketches after failures, from attempt `first` on."""
    both = F.size(left) + F.size(right)

    def attempt(k: int) -> Column:
        cells = (F.ceil(both * (FIRST_SHARE * GROWTH**k) / 3).cast("int") + 3) * 3
        return bound(cells, lambda m: bound(peel(subtract(sketch(left, m), sketch(right, m)), m), lambda found: F.when(found.isNotNull(), F.size(found))))

    exact = F.size(F.array_except(left, right)) + F.size(F.array_except(right, left))
    return F.coalesce(*[attempt(k) for k in range(first, ATTEMPTS)], exact)


def likeness(left: Column, right: Column, differing: Column | None = None) -> Column:
    """Jaccard similarity of two texts' digests from the number that differ (by default found here)."""
    both = F.size(left) + F.size(right)
    of = lambda d: ((both - d) / (both + d)).cast("double")
    return F.when(both == 0, F.lit(1.0)).otherwise(of(differing) if differing is not None else bound(difference(left, right), of))


def third_of(pieces: Column) -> Column:
    """Cells of each of the three tables of a sketch for so many pieces: the least power of two times SMALLEST that suffices."""
    return (F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(pieces * (CELLS_A_PIECE / 3 / SMALLEST), F.lit(1.0))))) * SMALLEST).cast("int")


def fingerprint(pieces: Column, cells: Column) -> Column:
    """A fingerprint as text: the number of pieces, the cells of a table, and place, count and digests of each cell, in hexadecimal."""
    said = lambda c: F.concat(F.hex(c["at"].cast("bigint")), F.lit("x"), F.hex(c["n"].cast("bigint")), F.lit("x"), F.lpad(F.hex(c["key"]), 16, "0"))
    return F.concat_ws(":", pieces.cast("string"), third_of(pieces).cast("string"), F.array_join(F.transform(cells, said), "."))


def parsed(text: Column) -> Column:
    """pieces, third and cells of a fingerprint's text."""
    number = lambda h: F.conv(h, 16, -10).cast("bigint")
    cell = lambda c: bound(F.split(c, "x"), lambda f: F.struct(number(f[0]).cast("int").alias("at"), number(f[1]).cast("int").alias("n"), number(f[2]).alias("key")))
    fields = F.split(text, ":")
    cells = F.when(fields[2] == "", F.array().cast(_CELL)).otherwise(F.transform(F.split(fields[2], "[.]"), cell))
    return F.struct(fields[0].cast("int").alias("pieces"), fields[1].cast("int").alias("third"), cells.alias("cells"))


def folded(cells: Column, third: Column, to: Column) -> Column:
    """Cells of a sketch with tables of `third` cells as those of one with tables of `to` cells, not more."""
    return _merged(F.transform(cells, lambda c: F.struct((F.floor(c["at"] / third).cast("int") * to + c["at"] % third % to).alias("at"), c["n"].alias("n"), c["key"].alias("key"))))


def differing_pieces(left: Column, right: Column) -> Column:
    """Number of digests that differ, from two fingerprints' texts alone; null where they hold too few cells for it."""
    sizes = lambda l, r: F.least(l["third"], r["third"])
    both = lambda l, r: bound(sizes(l, r), lambda t: peel(subtract(folded(l["cells"], l["third"], t), folded(r["cells"], r["third"], t)), t * 3))
    return bound(parsed(left), lambda l: bound(parsed(right), lambda r: bound(both(l, r), lambda found: F.when(found.isNotNull(), F.size(found)))))


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, and the text of the next document in descending doc_id (of the first, after the last).

    Documents are dealt to ranges of doc_id of about RANGE_ROWS documents, whose ends are ids of documents; the first document of each range also goes to the
    range before it, as the next of that range's last. So one shuffle does, and only the ends (a number for each range) reach the driver. Rows that share
    one id are in one range, which is sorted with spilling.
    """
    spark = docs.sparkSession
    lowest = -(1 << 63)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(lowest)).alias("o"), F.coalesce("text", F.lit("")).alias("text"))
    doc_id = F.when(F.col("o") != lowest, F.col("o")).alias("doc_id")  # no column of its own: all uses of the shuffled rows then share one shuffle
    ids, partitions = rows.select("o"), int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    n = max(4 * partitions, -(-ids.count() // RANGE_ROWS))  # several to a partition, so that partitions are even
    got = ids.agg(F.percentile_approx("o", [i / n for i in range(1, n)] if n > 1 else [0.5], 20 * n).alias("ends"), F.max("o").alias("last")).first()
    ends = sorted({*(got["ends"] or []), *([got["last"]] if got["last"] is not None else [])})
    if not ends:
        return rows.select(F.lit(0).alias("range"), F.lit(1).alias("nth"), doc_id, "text", F.col("text").alias("next"))
    at = F.array(*[F.lit(e) for e in ends])
    # binary search for the number of ends below o
    halve = lambda s, _: bound(F.shiftright(s["low"] + s["high"], 1), lambda m: F.when(s["low"] >= s["high"], s).when(F.get(at, m) < F.col("o"), F.struct((m + 1).alias("low"), s["high"].alias("high"))).otherwise(F.struct(s["low"].alias("low"), m.alias("high"))))
    place = F.aggregate(F.sequence(F.lit(1), F.lit(len(ends).bit_length())), F.struct(F.lit(0).alias("low"), F.lit(len(ends)).alias("high")), halve, lambda s: s["low"])
    here = lambda r, helper: F.struct(r.alias("range"), F.lit(helper).alias("helper"))
    is_end = F.get(at, F.col("r")) == F.col("o")
    both = F.when(is_end, F.array(here(F.col("r"), 0), here(F.pmod(F.col("r") + 1, F.lit(len(ends))), 1))).otherwise(F.array(here(F.col("r"), 0)))
    dealt = rows.withColumn("r", place).withColumn("to", F.explode(both)).select("o", "text", "to.*")
    if n > 4 * partitions:
        dealt = dealt.repartition(n // 4, "range")
    w = Window.partitionBy("range").orderBy("helper", F.col("o").desc(), "text")
    dealt = dealt.withColumn("next", F.lead("text").over(w)).withColumn("nth", F.row_number().over(w))
    return dealt.where("helper = 0").select("range", "nth", doc_id, "text", "next")


def _places(third: Column) -> list[Column]:
    """The cells of the digest `key` in the three tables."""
    return [F.pmod(F.shiftright("key", 13 * j + 11), third).cast("int") + third * j for j in range(3)]


def _put(i: int, keys: Column, n: int, third: Column) -> Column:
    return F.transform(keys, lambda k: F.struct(F.lit(i).alias("pair"), k.alias("key"), F.lit(n).alias("n"), third.alias("third")))


def sketches(rows: DataFrame, columns: list[str]) -> DataFrame:
    """range, nth and f_a, f_b, ...: the fingerprint's cells of each column a, b, ... of digests, in order of place. rows are partitioned by (range, nth)."""
    all_ = F.concat(*[_put(i, F.col(c), 1, third_of(F.size(c))) for i, c in enumerate(columns)])
    cells = rows.select("range", "nth", F.explode(all_).alias("d")).select("range", "nth", "d.*").withColumn("at", F.explode(F.array(*_places(F.col("third")))))
    cells = cells.groupBy("range", "nth", "pair", "at").agg(F.sum("n").cast("int").alias("n"), F.bit_xor("key").alias("key"))
    own = lambda i, c: F.array_sort(F.collect_list(F.when(F.col("pair") == i, F.struct("at", "n", "key")))).alias(f"f_{c}")
    return cells.groupBy("range", "nth").agg(*[own(i, c) for i, c in enumerate(columns)])


def _summed(cells: DataFrame) -> DataFrame:
    return cells.groupBy("range", "nth", "pair", "third", "at").agg(F.sum("n").cast("int").alias("n"), F.bit_xor("key").alias("key")).where("n <> 0 or key <> 0")


def peeled(cells: DataFrame, pairs: int) -> DataFrame:
    """range, nth and for each pair d0, d1, ...: digests recovered from the cells (range, nth, pair, third, at, n, key), and open0, ...: cells left.

    A step peels the cells of one of the three tables, in which a digest has one cell only.
    """
    cells = _summed(cells)
    cell = lambda at, n, k: F.struct(at.alias("at"), n.alias("n"), k.alias("key"))
    for step in range(STEPS):
        j = step % 3
        pure = (F.col("at") >= F.col("third") * j) & (F.col("at") < F.col("third") * (j + 1)) & (F.abs("n") == 1)
        pure = pure & (_checked(F.col("key").bitwiseAND(F.lit(_HIGH))) == F.col("key"))
        found = F.array(*[cell(p, -F.col("n"), F.col("key")) for i, p in enumerate(_places(F.col("third"))) if i != j], cell(F.lit(-1), F.lit(1), F.lit(0).cast("bigint")))
        out = F.when(pure, found).otherwise(F.array(cell(F.col("at"), F.col("n"), F.col("key"))))
        cells = _summed(cells.select("range", "nth", "pair", "third", F.explode(out).alias("c")).select("range", "nth", "pair", "third", "c.*"))
    per = []
    for i in range(pairs):
        own = F.col("pair") == i
        per += [F.coalesce(F.sum(F.when(own & (F.col("at") == -1), F.col("n"))).cast("int"), F.lit(0)).alias(f"d{i}"), F.count_if(own & (F.col("at") >= 0)).alias(f"open{i}")]
    return cells.groupBy("range", "nth").agg(*per)


def _folded_cells(pair: int, cells: str, third: str, to: Column, sign: int) -> Column:
    """A fingerprint's cells, folded to tables of `to` cells, as rows of a pair."""
    place = lambda c: F.floor(c["at"] / F.col(third)).cast("int") * to + c["at"] % F.col(third) % to
    return F.transform(cells, lambda c: F.struct(F.lit(pair).alias("pair"), to.alias("third"), place(c).alias("at"), (c["n"] * sign).alias("n"), c["key"].alias("key")))


def compared(rows: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """rows (keyed by range and nth) with d0, d1, ...: how many digests differ between the two columns of each pair, and f_ and the name of each column of
    digests: the cells of its fingerprint.

    First the fingerprints are folded to one size, subtracted and peeled; pairs that don't come to nothing in STEPS steps are compared again in sketches of
    their digests, sized for the pieces of both, and at last by `difference`. All shuffles are of rows by (range, nth); cells stay in the partition of their row.
    """
    rows, columns = rows.repartition("range", "nth"), list(dict.fromkeys(c for pair in pairs for c in pair))
    prints = sketches(rows, columns)
    sizes = rows.select("range", "nth", *[third_of(F.size(c)).alias(f"t_{c}") for c in columns])
    wide, subtracted = prints.join(sizes, ["range", "nth"]), []
    for i, (l, r) in enumerate(pairs):
        to = F.least(f"t_{l}", f"t_{r}")
        subtracted += [_folded_cells(i, f"f_{c}", f"t_{c}", to, sign) for c, sign in ((l, 1), (r, -1))]
    cells = wide.select("range", "nth", F.explode(F.concat(*subtracted)).alias("c")).select("range", "nth", "c.*")
    first = written(peeled(cells, len(pairs)), "peeled")
    again = first.where(" or ".join(f"open{i} > 0" for i in range(len(pairs)))).select("range", "nth", *[f"open{i}" for i in range(len(pairs))])
    larger = []
    for i, (l, r) in enumerate(pairs):
        a, b = F.col(l), F.col(r)
        third = third_of(F.size(a) + F.size(b))
        larger += [F.when(F.col(f"open{i}") > 0, _put(i, c, sign, third)).otherwise(F.array()) for c, sign in ((a, 1), (b, -1))]
    cells = rows.join(again, ["range", "nth"]).select("range", "nth", F.explode(F.concat(*larger)).alias("d")).select("range", "nth", "d.*")
    second = peeled(cells.withColumn("at", F.explode(F.array(*_places(F.col("third"))))), len(pairs))
    second = second.select("range", "nth", *[F.col(f"{c}{i}").alias(f"{c}{i}_") for i in range(len(pairs)) for c in ("d", "open")])
    out = rows.join(prints, ["range", "nth"], "left").join(first, ["range", "nth"], "left").join(second, ["range", "nth"], "left")
    for i, (l, r) in enumerate(pairs):
        done = F.when(F.coalesce(F.col(f"open{i}"), F.lit(0)) == 0, F.coalesce(F.col(f"d{i}"), F.lit(0))).when(F.coalesce(F.col(f"open{i}_"), F.lit(0)) == 0, F.coalesce(F.col(f"d{i}_"), F.lit(0)))
        out = out.withColumn(f"d{i}", done.otherwise(difference(F.col(l), F.col(r), 1)))
    return out.withColumns({f"f_{c}": F.coalesce(f"f_{c}", F.array().cast(_CELL)) for c in columns})


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_next(documents(spark, sf_dir))
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    rows = rows.withColumn("n_chars", n.cast("long")).withColumn("edited", F.concat(F.substr("text", F.lit(1), n - third), F.substr("next", F.lit(1), third)))
    rows = rows.select("range", "nth", "doc_id", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"), digests(F.col("text")).alias("a"), digests(F.col("edited")).alias("e"), digests(F.col("next")).alias("x"))
    rows = written(rows, "digests")  # texts are cut and hashed once, and their shuffle isn't needed any more
    a, e, x = F.col("a"), F.col("e"), F.col("x")
    rows = compared(rows, [("a", "e"), ("a", "x")])
    return rows.select("doc_id", "n_chars", "edited_sha256", fingerprint(F.size(a), F.col("f_a")).alias("fingerprint"), fingerprint(F.size(e), F.col("f_e")).alias("edited_fingerprint"), likeness(a, e, F.col("d0")).alias("near_edited"), likeness(a, x, F.col("d1")).alias("near_next"))

"""Tokens of classes by priority: what a class takes is hidden from the classes after it. SQL functions only, one split and one walk over the parts a class."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Stands before and after a match, and in place of what is taken; texts that hold them get INSTEAD there first.
MARK, TAKEN, INSTEAD = "\u0001", "\u0002", "�"
#: Parts that are walked at a time.
BLOCK = 256
SPAN = "array<struct<start:int,end:int,kind:string,token:string>>"

#: Dates by precision: days, then months, then years, never inside an earlier one.
DATES = [
    ("DAY", r"(?<![0-9./-])(?:[0-3]?[0-9]\.[01]?[0-9]\.(?:[0-9]{4}|[0-9]{2})|[0-9]{4}-[01][0-9]-[0-3][0-9])(?![0-9])"),
    ("MONTH", r"(?<![0-9./-])(?:[01]?[0-9][./](?:1[89]|2[01])[0-9]{2}|(?:1[89]|2[01])[0-9]{2}-[01][0-9])(?![0-9-])"),
    ("YEAR", r"(?<![0-9])(?:1[89]|2[01])[0-9]{2}(?![0-9])"),
]


def _parts(text: Column, pattern: str) -> Column:
    """The text cut at the matches, which are the odd parts."""
    return F.split(F.regexp_replace(text, f"({pattern})", MARK + "$1" + MARK), MARK)


def masked_spans(df: DataFrame, text: str, classes: list[tuple[str, str]], out: str = "spans") -> DataFrame:
    """df with `out`: start, end (code points, exclusive), kind and token of each match of the classes (kind, pattern), in order of start.

    A match of a class hides its characters from the classes after it (patterns see a sign there that is neither digit nor letter nor blank), so no two spans overlap.
    A null text has no spans. Patterns must not match an empty text or have groups that capture.
    """
    hidden = F.translate(F.coalesce(text, F.lit("")), MARK + TAKEN, INSTEAD * 2)
    rows, names = df.withColumn("__t0", hidden), []
    for i, (kind, pattern) in enumerate(classes):
        parts = F.col(f"__p{i}")
        rows = rows.withColumn(f"__p{i}", _parts(F.col(f"__t{i}"), pattern))
        # where each part ends: running lengths, one struct a part
        rows = rows.withColumn(f"__n{i}", F.transform(parts, lambda p: F.length(p)))
        odd = F.filter(F.sequence(F.lit(0), F.size(parts) - 1), lambda k: k % 2 == 1)
        masked = F.array_join(F.transform(parts, lambda p, k: F.when(k % 2 == 1, F.repeat(F.lit(TAKEN), F.length(p))).otherwise(p)), "")
        rows = rows.withColumn(f"__m{i}", odd).withColumn(f"__t{i + 1}", masked)
        names.append(kind)
    found = F.array().cast(SPAN)
    for i, kind in enumerate(names):
        found = F.concat(found, F.when(F.size(f"__m{i}") > 0, _spans(F.col(f"__p{i}"), F.col(f"__n{i}"), kind)).otherwise(F.array().cast(SPAN)))
    return rows.withColumn(out, F.array_sort(found)).select(*df.columns, out)


def _spans(parts: Column, sizes: Column, kind: str) -> Column:
    """Spans of the odd parts: the parts are walked in blocks of BLOCK, each from the place at which it begins, so that lists stay short while they grow."""
    numbered = F.transform(F.arrays_zip(parts.alias("p"), sizes.alias("n")), lambda x, k: F.struct(x["p"].alias("p"), x["n"].alias("n"), k.alias("k")))
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / BLOCK).cast("int")), lambda b: F.slice(numbered, b * BLOCK + 1, F.lit(BLOCK)))
    sums = F.transform(F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / BLOCK).cast("int")), lambda b: F.aggregate(F.slice(sizes, b * BLOCK + 1, F.lit(BLOCK)), F.lit(0), lambda t, n: t + n))
    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("got"))
    begins = F.aggregate(sums, first, lambda s, n: F.struct((s["at"] + n).alias("at"), F.concat(s["got"], F.array(s["at"])).alias("got")), lambda s: s["got"])

    def step(s: Column, x: Column) -> Column:
        a = s["at"]
        span = F.struct(a.alias("start"), (a + x["n"]).alias("end"), F.lit(kind).alias("kind"), x["p"].alias("token"))
        return F.struct((a + x["n"]).alias("at"), F.when(x["k"] % 2 == 1, F.concat(s["got"], F.array(span))).otherwise(s["got"]).alias("got"))

    walk = lambda z: F.aggregate(z["b"], F.struct(z["a"].alias("at"), F.array().cast(SPAN).alias("got")), step, lambda s: s["got"])
    return F.flatten(F.transform(F.arrays_zip(blocks.alias("b"), begins.alias("a")), walk))

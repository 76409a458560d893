"""Personal data: regular expressions propose spans, checksums confirm them, nearby words adjust the score.

Built from SQL functions only. A match is put between two marks, the text is split there, and running lengths give the places of
the matches in code points. Email, IP address, card (Luhn) and phone are the base kinds: every match that passes its check stays.
IBANs (mod 97, as long as their country's are) and national ids (by context, words on either side) are added where their score reaches LEAST_SCORE. The patterns use possessive repeats
and start only at the end of the last match or of another run, which finds the same matches without backtracking, however long a run is.

Defined results: a null or empty text has no span; repeated rows are searched each; an empty table gives an empty result. Extra columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.llm.common import documents

MARK, INSTEAD = "", ""
KINDS = ("email", "ip", "card", "phone", "iban", "national_id")
BASE = KINDS[:4]
_AFTER = r"(?:\G|(?<![{0}]))"
PATTERNS = {
    "email": _AFTER.format("A-Za-z0-9._%+-") + r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": _AFTER.format("0-9") + r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    # only where one may start: its end is that of its country's length, see _iban
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=(?:\x20?[A-Z0-9]){11})",
    "national_id": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
#: What a text must contain for a kind to be searched: cheap tests that rule out no match.
NEEDS = {"email": "@", "phone": "+"}
#: Score of a checked match of each kind; a context word adds CONTEXT_SCORE.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.8, "national_id": 0.3}
CONTEXT = {
    "email": "mail|contact|write",
    "ip": "ip|host|server|address",
    "card": "card|visa|credit|debit|pay",
    "phone": "phone|tel|call|mobile|fax",
    "iban": "iban|account|bank|konto",
    "national_id": "ssn|social|security|national|identity",
}
CONTEXT_SCORE, CONTEXT_CHARACTERS, LEAST_SCORE = 0.3, 40, 0.5
#: Characters of an IBAN in each country of the registry; for other countries all lengths from 15 to 34 are tried.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
#: Characters of the longest IBAN with a blank after each character.
_IBAN_CHARACTERS = 67
_SPAN = "array<struct<start:int,kind:int,end:int,score:double>>"


def _octet(i: str) -> str:
    return rf"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{{1,2}}){i}"


def _passes(kind: str, m: Column) -> Column:
    if kind == "ip":
        return m.rlike("^" + r"\.".join(_octet("") for _ in range(4)) + "$")
    if kind == "card":
        digits = F.regexp_replace(m, "[ -]", "")
        return F.length(digits).between(12, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(F.regexp_replace(m, "[^0-9]", "")).between(9, 15)
    return F.lit(True)


def _iban(text: Column) -> Column:
    """Characters of the IBAN with which a text starts (mod 97; no letter or digit after it), or 0."""
    want = F.lit(0)
    for n, countries in IBAN_LENGTHS.items():
        want = F.when(F.substring(text, 1, 2).isin(countries.split()), n).otherwise(want)
    value = lambda c: F.when(c < 58, c - 48).otherwise(c - 55)
    add = lambda a, c: F.when(c < 58, (a * 10 + value(c)) % 97).otherwise((a * 100 + value(c)) % 97)
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("head"), F.lit(0).alias("rest"), F.lit(False).alias("blank"), F.lit(False).alias("over"), F.lit(0).alias("size"))

    def step(s: Column, i: Column) -> Column:
        c, after = F.substr(text, i, F.lit(1)), F.substr(text, i + 1, F.lit(1))
        taken, blank = c.rlike("^[A-Z0-9]$"), c == " "
        over = s["over"] | ~(taken | (blank & ~s["blank"]))
        n = s["n"] + F.when(taken, 1).otherwise(0)
        head = F.when(taken & (n <= 4), add(s["head"], F.ascii(c))).otherwise(s["head"])
        rest = F.when(taken & (n > 4), add(s["rest"], F.ascii(c))).otherwise(s["rest"])
        # the first four characters, six digits, come last: 10 ** 6 % 97 is 27
        ok = ~over & taken & F.when(want > 0, n == want).otherwise(n.between(15, 34)) & ((rest * 27 + head) % 97 == 1) & ~after.rlike("^[A-Za-z0-9]$")
        return F.struct(n.alias("n"), head.alias("head"), rest.alias("rest"), blank.alias("blank"), over.alias("over"), F.when(ok, i).otherwise(s["size"]).alias("size"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(_IBAN_CHARACTERS)), start, step, lambda s: s["size"])


def find(text: Column, kind: str) -> Column:
    """The spans of a kind in a text without MARK: array of start, kind's number, end (exclusive), score; in order."""
    n = KINDS.index(kind)
    parts = F.split(F.regexp_replace(text, PATTERNS[kind], MARK + "$0" + MARK), MARK)
    start = F.struct(F.lit(0).alias("at"), F.lit(1).alias("i"), F.lit("").alias("before"), F.lit(0).alias("until"), F.array().cast(_SPAN).alias("spans"))

    def walk(parts: Column, firsts: Column) -> Column:
        # a match or what lies between two; what follows is put together from the first characters of as many parts as can matter (a match has four or more)
        def following(i: Column, characters: int) -> Column:
            return F.left(F.array_join(F.slice(firsts, i, F.lit(characters // 2 + 1)), ""), F.lit(characters))

        def step(state: Column, part: Column) -> Column:
            hit, at = state["i"] % 2 == 0, state["at"]
            size = F.length(part)
            if kind == "iban":
                ends = at + F.when(hit & (at >= state["until"]), _iban(following(state["i"], _IBAN_CHARACTERS + 1))).otherwise(0)
                ok = hit & (ends > at)
                after = F.substr(following(state["i"], _IBAN_CHARACTERS + CONTEXT_CHARACTERS), ends - at + 1, F.lit(CONTEXT_CHARACTERS))
            else:
                ends, ok, after = at + size, hit & _passes(kind, part), following(state["i"] + 1, CONTEXT_CHARACTERS)
            near = F.lower(F.concat(state["before"], F.lit("\n"), after)).rlike(CONTEXT[kind])
            score = F.lit(SCORES[kind]) + F.when(near, CONTEXT_SCORE).otherwise(0.0)
            score = F.least(F.lit(1.0), score)
            if kind not in BASE:
                ok = ok & (score >= LEAST_SCORE)
            span = F.struct(at.alias("start"), F.lit(n).alias("kind"), ends.alias("end"), score.alias("score"))
            before = F.right(F.concat(state["before"], F.right(part, F.lit(CONTEXT_CHARACTERS))), F.lit(CONTEXT_CHARACTERS))
            until = F.when(ok, ends).otherwise(state["until"])
            return F.struct((at + size).alias("at"), (state["i"] + 1).alias("i"), before.alias("before"), until.alias("until"), F.when(ok, F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"))

        return F.aggregate(parts, start, step, lambda s: s["spans"])

    # most texts have no match: then there is one part, and nothing to walk
    first = lambda x: F.left(x, F.lit(_IBAN_CHARACTERS + CONTEXT_CHARACTERS))
    pair = F.array(F.struct(parts.alias("p")))
    pair = F.transform(pair, lambda x: F.struct(x["p"].alias("p"), F.when(F.size(x["p"]) > 1, F.transform(x["p"], first)).alias("f")))
    return F.transform(pair, lambda x: F.when(F.size(x["p"]) > 1, walk(x["p"], x["f"])).otherwise(F.array().cast(_SPAN)))[0]


def spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with `spans`: array of start, kind (number in KINDS), end, score, by start and kind."""
    t = F.coalesce(F.col(text), F.lit(""))
    rows = docs.withColumn("__t", F.when(F.contains(t, F.lit(MARK)), F.translate(t, MARK, INSTEAD)).otherwise(t))
    t, none = F.col("__t"), F.array().cast(_SPAN)
    rows = rows.withColumn("__digit", t.rlike("[0-9]"))
    for kind in KINDS:
        needs = F.contains(t, F.lit(NEEDS[kind])) if kind in NEEDS else F.col("__digit")
        rows = rows.withColumn(f"__{kind}", F.when(needs, find(t, kind)).otherwise(none))
    return rows.withColumn("spans", F.array_sort(F.concat(*[F.col(f"__{k}") for k in KINDS]))).drop("__t", "__digit", *[f"__{k}" for k in KINDS])


def _said(found: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spans(documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", "spans")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == KINDS.index(k))).cast("long").alias(f"n_{k}")
    base = F.filter("spans", lambda s: s["kind"] < len(BASE))
    scores = F.array_join(F.transform("spans", lambda s: F.format_number(s["score"], 2)), ",")
    return found.select("doc_id", *[count(k) for k in BASE], F.sha2(_said(base), 256).alias("base_sha256"), _said(F.col("spans")).alias("spans"), scores.alias("scores"))

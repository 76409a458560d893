"""Secrets: patterns of known forms, and a battery of randomness tests for strings of any other form.

A candidate is a long run of encoding characters that stands alone. Its encoding is inferred from its characters (hex, base32, base36, base62, base64); what fits
none, such as plain words and numbers, is no candidate. Its symbols are tested three times: chi-squared of the counts against a uniform alphabet (moments exact for
short strings), runs above and below the alphabet's middle (Wald-Wolfowitz), and serial correlation with the next symbol; Fisher's method joins them to one p.

For random strings p is uniform, for others it lies near 0, the nearer the longer they are. So in each stratum of encoding and length the number of random strings is
twice that of p over a half, and the strings with p above a cut are a mixture whose other part is what exceeds the random strings' share: the smallest cut is taken
at which that part, the false discoveries, is at most FALSE_SHARE. Each distinct string counts once; counts are kept by p's bin, so they need no ranks.

Defined results: null or empty texts have no spans; repeated rows are searched each, and texts are searched whole; ties of start follow the kinds' order; an empty
table gives an empty result; other columns are left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import erfc, exp, log, sqrt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.llm.common import documents, trimmed, written

KINDS = ("assign", "access", "hex", "random")
BASE = KINDS[:3]
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_WORDS = ("passw", "secret", "token", "api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
#: Least symbols of a candidate: under it the tests tell words and random strings not apart.
LEAST = 20
_CANDIDATE = re.compile(rf"(?<![\w+/=-])[A-Za-z0-9+/_-]{{{LEAST},}}={{0,2}}(?![\w+/=-])")
_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Alphabets in their symbols' order. A string has the first that holds all its characters.
ALPHABETS = {
    "hex": _DIGITS + "abcdef", "HEX": _DIGITS + "ABCDEF", "base32": _UPPER + "234567", "base36": _DIGITS + _LOWER, "BASE36": _DIGITS + _UPPER,
    "base62": _UPPER + _LOWER + _DIGITS, "base64": _UPPER + _LOWER + _DIGITS + "+/", "base64url": _UPPER + _LOWER + _DIGITS + "-_",
}
_CODES = {name: {c: i for i, c in enumerate(a)} for name, a in ALPHABETS.items()}
#: Lengths at which the strata begin.
STRATA = (20, 24, 32, 48, 64, 128)
BINS, FALSE_SHARE = 100, 0.1
_SPANS = "array<struct<kind:int,start:int,end:int>>"
_FOUND = "array<struct<start:int,end:int,encoding:int,stratum:int,p:double,hash:bigint>>"


def encoding_of(token: str) -> str | None:
    """The encoding whose characters a string has; None for numbers, words and words joined by signs."""
    kinds = [any(c in _DIGITS for c in token), any(c in _LOWER for c in token), any(c in _UPPER for c in token)]
    if not kinds[0] or sum(kinds) < 2:
        return None
    body = token.rstrip("=")
    for name, codes in _CODES.items():
        if all(c in codes for c in body):
            return name if name not in ("base64", "base64url") or all(kinds) else None
    return None


def _two_sided(z: float) -> float:
    return erfc(abs(z) / sqrt(2))


def battery(token: str, encoding: str) -> tuple[float, float, float]:
    """p of the uniformity, runs and serial correlation tests of a string of LEAST symbols or more."""
    codes, k = _CODES[encoding], len(ALPHABETS[encoding])
    x = np.array([codes[c] for c in token.rstrip("=")], float)
    n = len(x)
    counts = np.bincount(x.astype(int), minlength=k)
    chi = ((counts - n / k) ** 2).sum() / (n / k)
    uniform = _two_sided((chi - (k - 1)) / sqrt(2 * (k - 1) * (n - 1) / n))
    high = x > (k - 1) / 2
    a, b = int(high.sum()), int((~high).sum())
    if not a or not b:
        return uniform, 0.0, 0.0
    changes, both = 1 + int((high[1:] != high[:-1]).sum()), 2 * a * b
    spread = both * (both - n) / (n * n * (n - 1))
    runs = _two_sided((changes - 1 - both / n) / sqrt(spread)) if spread > 0 else 0.0
    d = x - x.mean()
    total = (d * d).sum()
    serial = _two_sided(((d[1:] * d[:-1]).sum() / total + 1 / n) * sqrt(n)) if total else 0.0
    return uniform, runs, serial


def joined_p(ps: tuple[float, ...]) -> float:
    """Fisher's p of three tests: the survival function of chi-squared with six degrees of freedom."""
    half = -sum(log(max(p, 1e-300)) for p in ps)
    return exp(-half) * (1 + half + half * half / 2)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the known forms, leftmost and without overlaps for each kind."""
    low = text.lower()
    out = [(0, m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6] if any(w in low for w in _WORDS) else []
    out += [(1, m.start(), m.end()) for m in _ACCESS.finditer(text)] if "AKIA" in text else []
    return out + [(2, m.start(), m.end()) for m in _HEX.finditer(text)]


def candidates(text: str) -> list[dict]:
    out = []
    for m in _CANDIDATE.finditer(text):
        name = encoding_of(m[0])
        size = len(m[0].rstrip("="))
        if name and size >= LEAST:
            p = joined_p(battery(m[0], name))
            out.append({"start": m.start(), "end": m.end(), "encoding": list(ALPHABETS).index(name), "stratum": max(s for s in STRATA if s <= size), "p": p, "hash": _hash(m[0])})
    return out


def _hash(token: str) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(token.encode()) - (1 << 63)


@trimmed
def _searched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        texts = [t if isinstance(t, str) else "" for t in rows["text"]]
        base = [[{"kind": k, "start": a, "end": b} for k, a, b in base_spans(t)] for t in texts]
        yield pd.DataFrame({"doc_id": rows["doc_id"], "base": base, "found": [candidates(t) for t in texts]})


def cuts(found: DataFrame, false_share: float = FALSE_SHARE) -> dict[tuple[int, int], float]:
    """(encoding, stratum) -> the least p of a discovery, from the column `found`; a row for each stratum and bin is all that comes to the driver."""
    one = found.select(F.explode("found").alias("f")).select("f.encoding", "f.stratum", F.least(F.floor(F.col("f.p") * BINS), F.lit(BINS - 1)).cast("int").alias("bin"), "f.hash").distinct()
    counts: dict[tuple[int, int], np.ndarray] = {}
    for r in one.groupBy("encoding", "stratum", "bin").agg(F.count(F.lit(1)).alias("n")).collect():
        counts.setdefault((r["encoding"], r["stratum"]), np.zeros(BINS))[r["bin"]] += r["n"]
    return {key: cut(c, false_share) for key, c in counts.items()}


def cut(counts: np.ndarray, false_share: float) -> float:
    """The least bin border above which at most false_share of the strings aren't random; 1 (no string) where none has a p over a half."""
    above = counts[::-1].cumsum()[::-1]
    random = 2 * above[BINS // 2]
    for i in range(BINS // 2 + 1):
        if above[i] and 1 - random * (1 - i / BINS) / above[i] <= false_share:
            return i / BINS
    return 1.0


def secrets(docs: DataFrame, false_share: float = FALSE_SHARE) -> DataFrame:
    """doc_id, spans: kind (number in KINDS), start and end of the known forms and of the random strings that touch none of them, by start and kind."""
    found = written(docs.select("doc_id", "text").mapInPandas(_searched, f"doc_id {dict(docs.dtypes)['doc_id']}, base {_SPANS}, found {_FOUND}"), "secrets")
    least = cuts(found, false_share)
    limits = F.create_map(*[F.lit(v) for (e, s), p in sorted(least.items()) for v in (f"{e}:{s}", p)]) if least else F.create_map(F.lit(""), F.lit(1.0))
    cut_of = lambda x: F.coalesce(F.element_at(limits, F.concat_ws(":", x["encoding"].cast("string"), x["stratum"].cast("string"))), F.lit(1.0))
    free = lambda x: ~F.exists("base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"]))
    taken = F.filter("found", lambda x: (x["p"] >= cut_of(x)) & (cut_of(x) < 1) & free(x))
    added = F.transform(taken, lambda x: F.struct(F.lit(KINDS.index("random")).alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    order = lambda a, b: F.when(a["start"] != b["start"], F.signum(a["start"] - b["start"])).otherwise(F.signum(a["kind"] - b["kind"])).cast("int")
    return found.select("doc_id", F.array_sort(F.concat("base", added), order).alias("spans"))


def _said(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets(documents(spark, sf_dir))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == KINDS.index(k))).cast("long").alias(f"n_{k}")
    base = F.filter("spans", lambda s: s["kind"] < len(BASE))
    return found.select("doc_id", *[count(k) for k in BASE], F.sha2(_said(base), 256).alias("base_sha256"), _said(F.col("spans")).alias("spans"))

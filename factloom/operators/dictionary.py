"""Dictionaries of any number of terms: longest matches in texts, and names resolved in stages.

A dictionary up to TRIE_BYTES goes to every task as a trie of words, through which a text is read once, whatever the number of terms. A larger one is met by joins: each text's
runs of up to as many words as the longest term has are dealt by their hash. Both give the same spans.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Largest dictionary (characters of its terms) that is sent to the tasks.
TRIE_BYTES = 64_000_000
_WORD = re.compile(r"[^\W_]+")
WORD = r"[\p{L}\p{N}]+"
AMBIGUOUS = "AMBIGUOUS"


def terms_of(terms: DataFrame, term: str, code: str) -> DataFrame:
    """__k (words in lower case, joined by blanks), code, n: each term once; code is null where equal terms have several codes. Terms without a word are left out."""
    words = F.regexp_extract_all(F.lower(term), F.lit(WORD), 0)
    rows = terms.select(words.alias("w"), F.col(code).cast("string").alias("c")).where("size(w) > 0 AND c IS NOT NULL")
    kept = rows.groupBy(F.array_join("w", " ").alias("__k")).agg(F.min("c").alias("a"), F.max("c").alias("b"), F.any_value(F.size("w")).alias("n"))
    return kept.select("__k", F.when(F.col("a") == F.col("b"), F.col("a")).alias("code"), "n")


def build_trie(terms: list[tuple[str, str | None]]) -> dict:
    """word -> deeper trie; under None the code of the term that ends there."""
    root: dict = {}
    for key, code in terms:
        node = root
        for w in key.split(" "):
            node = node.setdefault(w, {})
        node[None] = code
    return root


def trie_spans(trie: dict, text: str) -> Iterator[tuple[int, int, str | None]]:
    """(start, end, code) of the longest term at each place, from left to right, without overlaps."""
    words = [(m[0], m.start(), m.end()) for m in _WORD.finditer(text)]
    words = [(w.lower(), a, z) for w, a, z in words]
    i = 0
    while i < len(words):
        node, j, last = trie, i, None
        while j < len(words) and (node := node.get(words[j][0])) is not None:
            j += 1
            if None in node:
                last = (j, node[None])
        if last:
            yield words[i][1], words[last[0] - 1][2], last[1]
            i = last[0]
        else:
            i += 1


def find_terms(docs: DataFrame, doc_id: str, text: str, terms: DataFrame, term: str, code: str, *, trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """doc_id, start, end, code of the longest matches of the terms, as whole words in any case, left to right without overlaps; places are code points.

    A term with several codes matches with code AMBIGUOUS. Null texts have no match.
    """
    known = terms_of(terms, term, code).withColumn("code", F.coalesce("code", F.lit(AMBIGUOUS)))
    if (known.agg(F.sum(F.length("__k") + 64)).first()[0] or 0) > trie_bytes:
        return _joined(docs, doc_id, text, known)
    sent = docs.sparkSession.sparkContext.broadcast(build_trie([(r["__k"], r["code"]) for r in known.collect()]))  # no more than trie_bytes

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trie = sent.value
        for rows in batches:
            found = [(i, a, z, c) for i, t in zip(rows[doc_id], rows[text], strict=True) if isinstance(t, str) for a, z, c in trie_spans(trie, t)]
            yield pd.DataFrame(found, columns=[doc_id, "start", "end", "code"])

    return docs.select(doc_id, text).where(F.col(doc_id).isNotNull() & F.col(text).isNotNull()).mapInPandas(run, f"`{doc_id}` {dict(docs.dtypes)[doc_id]}, start int, end int, code string")


def _words(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, ws: array of (word in lower case, start, end)."""
    parts = F.split(F.regexp_replace(text, f"({WORD})", "\u0001$1\u0001"), "\u0001")
    sizes = F.transform(parts, lambda p: F.length(p))
    rows = docs.select(doc_id, F.posexplode(F.arrays_zip(parts.alias("p"), sizes.alias("n"))).alias("i", "x")).select(doc_id, "i", F.col("x.p").alias("p"), F.col("x.n").alias("n"))
    w = Window.partitionBy(doc_id).orderBy("i")
    at = F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.withColumn("a", at.cast("int")).where("i % 2 = 1").select(doc_id, ((F.col("i") - 1) / 2).cast("int").alias("k"), F.lower("p").alias("w"), "a", (F.col("a") + F.col("n")).cast("int").alias("z"))


def _joined(docs: DataFrame, doc_id: str, text: str, known: DataFrame) -> DataFrame:
    """The same by joins on the terms' text; overlaps are settled inside a document."""
    longest = known.agg(F.max("n")).first()[0] or 0
    if not longest:
        return docs.select(doc_id, F.lit(0).alias("start"), F.lit(0).alias("end"), F.lit("").alias("code")).limit(0)
    words = _words(docs.where(F.col(text).isNotNull()), doc_id, text)
    w = Window.partitionBy(doc_id).orderBy("k").rowsBetween(0, longest - 1)
    ahead = words.select(doc_id, "k", "a", F.collect_list(F.struct("w", "z")).over(w).alias("ws"))
    runs = ahead.select(doc_id, "k", "a", F.explode(F.transform(F.sequence(F.lit(1), F.size("ws")), lambda n: F.struct(n.alias("n"), F.array_join(F.transform(F.slice("ws", 1, n), lambda x: x["w"]), " ").alias("key"), F.get("ws", n - 1)["z"].alias("z")))).alias("r"))
    hits = runs.select(doc_id, "k", "a", "r.n", "r.z", F.col("r.key").alias("__k")).join(known.select("__k", "code"), "__k")
    best = hits.groupBy(doc_id, "k", "a").agg(F.max(F.struct("n", "z", "code")).alias("b"))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        free, keep = -1, []
        rows = rows.sort_values("k")
        for k, n in zip(rows["k"], rows["n"], strict=True):
            keep.append(k >= free)
            free = k + n if keep[-1] else free
        return rows[keep][[doc_id, "start", "end", "code"]]

    flat = best.select(doc_id, "k", F.col("b.n").alias("n"), F.col("a").alias("start"), F.col("b.z").alias("end"), F.col("b.code").alias("code"))
    return flat.groupBy(doc_id).applyInPandas(run, f"`{doc_id}` {dict(docs.dtypes)[doc_id]}, start int, end int, code string")


def resolve_staged(names: DataFrame, name: str, entries: DataFrame, entry: str, code: str, stages: list[tuple[str, Callable[[Column], Column]]]) -> DataFrame:
    """name, code, stage of each distinct name: the first stage (status, key function) at which the dictionary has the name's key decides.

    If the entries of that key differ in code the code is null and stage AMBIGUOUS: an ambiguous name never falls through to a looser stage. UNRESOLVED names have
    no entry at any stage. Names are made distinct first; each stage is an equality join. Null names, and keys that are null or empty, have no entry.
    """
    out = names.where(F.col(name).isNotNull()).select(F.col(name).alias("__n")).distinct()
    for i, (_, key) in enumerate(stages):
        side = entries.where(F.col(code).isNotNull()).select(key(F.col(entry)).alias(f"__k{i}"), F.col(code).cast("string").alias("__c")).where(F.length(f"__k{i}") > 0)
        side = side.groupBy(f"__k{i}").agg(F.min("__c").alias(f"__a{i}"), F.max("__c").alias(f"__b{i}"))
        out = out.withColumn(f"__k{i}", key(F.col("__n"))).join(side, f"__k{i}", "left")
    code_of, stage_of = F.lit(None).cast("string"), F.lit("UNRESOLVED")
    for i, (status, _) in reversed(list(enumerate(stages))):
        hit, one = F.col(f"__a{i}").isNotNull(), F.col(f"__a{i}") == F.col(f"__b{i}")
        code_of = F.when(hit, F.when(one, F.col(f"__a{i}"))).otherwise(code_of)
        stage_of = F.when(hit, F.when(one, status).otherwise(AMBIGUOUS)).otherwise(stage_of)
    return out.select(F.col("__n").alias(name), code_of.alias("code"), stage_of.alias("stage"))

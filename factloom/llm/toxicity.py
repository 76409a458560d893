"""Toxicity by multiple-instance learning: sentence scores, combined by noisy-or, learned from document labels.

A document is a bag of sentences. Sentence s has the logit b + sum of the weights of its listed words; the document is
toxic with probability 1 - (1 - leak) * prod(1 - p_s), where the leak takes up labels that no sentence explains. Weights,
b and leak are fitted to document labels only; the sentence scores then tell where the offence is.

A sentence runs from its first letter to the next stops or line ends, in training and in scoring alike; runs without a letter are none.

Defined results: null and empty texts and texts without a letter have no sentence and get the leak as score; repeated rows are scored each, and one of the
rows that share an id is learned from; an empty table gives an empty result; without labels of both kinds the share of label 1 (0 without labels) is every
score. Only text and the key are read, so extra columns change nothing.
"""

from __future__ import annotations

import re
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.llm.common import documents, held_out, sampled_texts, table, written

#: Bound of the training sample: documents of each label (first by a hash of the id), with their whole texts.
SAMPLE_DOCUMENTS = 3_000
#: Words that may get a weight: in so many toxic documents at least, and so much more often there (z score), the strongest so many; weights that count.
LEAST_DOCUMENTS, LEAST_Z, MOST_WORDS, LEAST_WEIGHT = 5, 4.0, 400, 0.5
THRESHOLD = 0.3
PREFIXES = (5, 6, 7, 8)

_SENTENCE = re.compile(r"[^\W\d_][^.!?\n]*[.!?\n]*")
_WORD = re.compile(r"[^\W\d_]+")


def lowered(text: str | None) -> str:
    """The text in lower case, each character in its place."""
    low = (text or "").lower()
    return low if len(low) == len(text or "") else "".join(c if len(c.lower()) != 1 else c.lower() for c in text)


def sentences(text: str) -> list[tuple[int, int]]:
    """Start and end of each sentence."""
    return [m.span() for m in _SENTENCE.finditer(text)]


def features(sentence: str) -> set[str]:
    """The words of a sentence (in lower case), and the starts of PREFIXES letters of longer words, marked with a star."""
    words = set(_WORD.findall(sentence))
    return words | {f"{w[:n]}*" for w in words for n in PREFIXES if len(w) > n}


def listed_words(rows: DataFrame, n1: int, n0: int) -> list[str]:
    """The words (and starts of words) that stand in toxic documents so much more often that they may get a weight; rows(toxic, text)."""

    def run(batches):
        for batch in batches:
            for y, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = sorted(features(lowered(text)))
                yield pa.RecordBatch.from_arrays([pa.array([y] * len(own), pa.int64()), pa.array(own, pa.string())], names=["toxic", "word"])

    seen = rows.mapInArrow(run, "toxic long, word string").groupBy("word").agg(F.sum("toxic").alias("s1"), F.sum(1 - F.col("toxic")).alias("s0"))
    p, q, both = F.col("s1") / n1, F.col("s0") / n0, (F.col("s1") + F.col("s0")) / (n1 + n0)
    z = (p - q) / F.sqrt(both * (1 - both) * (1 / n1 + 1 / n0) + 1e-12)
    return [r["word"] for r in seen.withColumn("z", z).where((F.col("s1") >= LEAST_DOCUMENTS) & (F.col("z") >= LEAST_Z)).orderBy(F.col("z").desc(), "word").limit(MOST_WORDS).collect()]


def bags(rows: DataFrame, listed: list[str]) -> DataFrame:
    """toxic, doc_id, number of sentences without a listed word, and the listed words (by number) of each other sentence."""
    place = {w: k for k, w in enumerate(listed)}

    def run(batches):
        for batch in batches:
            found, plain = [], []
            for text in batch.column(2).to_pylist():
                low = lowered(text)
                own = [sorted(place[f] for f in features(low[a:z]) if f in place) for a, z in sentences(low)]
                found.append([x for x in own if x])
                plain.append(len(own) - len(found[-1]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(plain, pa.int64()), pa.array(found, pa.list_(pa.list_(pa.int32())))], names=["toxic", "doc_id", "plain", "found"])

    return rows.select("toxic", "doc_id", "text").mapInArrow(run, "toxic long, doc_id long, plain long, found array<array<int>>")


def fit(found: list[list[list[int]]], plain: np.ndarray, labels: np.ndarray, weights: np.ndarray, n_words: int) -> tuple[np.ndarray, float, float]:
    """Word weights, b and leak that explain the labels; `weights` restores the shares of the labels in the table."""
    doc_of = np.array([d for d, bag in enumerate(found) for _ in bag], np.int64)
    flat = [s for bag in found for s in bag]
    sent, word = np.repeat(np.arange(len(flat)), [len(s) for s in flat]).astype(np.int64), np.array([w for s in flat for w in s], np.int64)
    y, v = labels.astype(float), weights / weights.sum()
    theta = np.concatenate([np.zeros(n_words), [-7.0, -3.0]])
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, 601):
        w, b, leak = theta[:-2], theta[-2], 1 / (1 + np.exp(-theta[-1]))
        zs = b + np.bincount(sent, w[word], len(doc_of)) if len(word) else np.full(len(doc_of), b)
        soft, p = np.logaddexp(0, zs), 1 / (1 + np.exp(-zs))
        soft_b, p_b = np.logaddexp(0, b), 1 / (1 + np.exp(-b))
        total = np.bincount(doc_of, soft, len(y)) + plain * soft_b - np.log1p(-leak)
        rest = np.exp(-total)
        d_total = v * ((1 - y) - y * rest / np.maximum(1 - rest, 1e-9))
        dz = d_total[doc_of] * p
        grad = np.concatenate([np.bincount(word, dz[sent], len(w)) if len(word) else np.zeros(len(w)), [dz.sum() + (d_total * plain).sum() * p_b, d_total.sum() * leak]])
        grad[:-2] += 2e-5 * w
        mean, square = 0.9 * mean + 0.1 * grad, 0.99 * square + 0.01 * grad**2
        theta = theta - 0.05 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
        theta[:-2] = np.maximum(theta[:-2], 0)
    return theta[:-2], float(theta[-2]), float(1 / (1 + np.exp(-theta[-1])))


class Scorer:
    """Scores texts with a fitted model; one pass over each whole text finds the listed words."""

    def __init__(self, model: dict):
        import ahocorasick

        self.model, self.find = model, None
        if model["words"]:
            self.find = ahocorasick.Automaton()
            for w, x in model["words"].items():
                whole = not w.endswith("*")
                own = w.rstrip("*")
                self.find.add_word(own, self.find.get(own, ()) + ((len(own), whole, w, x),))
            self.find.make_automaton()

    def __call__(self, text: str | None) -> tuple[float, list[tuple[int, int, float]]]:
        """The document's score, and start, end and score of each sentence with a listed word."""
        b, leak = self.model["b"], self.model["leak"]
        low = lowered(text)
        own = sentences(low)
        if not own:
            return leak, []
        hits: dict[int, dict[str, float]] = {}
        if self.find is not None:
            starts = [a for a, _ in own]
            for end, found in self.find.iter(low):
                z = end + 1
                longer = z < len(low) and _letter(low[z])
                for size, whole, name, x in found:
                    a = z - size
                    if whole != longer and not (a and _letter(low[a - 1])):
                        hits.setdefault(bisect_right(starts, a) - 1, {})[name] = x
        total = -np.log1p(-leak) + (len(own) - len(hits)) * float(np.logaddexp(0, b))
        spans = []
        for s in sorted(hits):
            z = b + sum(hits[s].values())
            total += float(np.logaddexp(0, z))
            spans.append((*own[s], float(1 / (1 + np.exp(-z)))))
        return float(-np.expm1(-total)), spans


def _letter(c: str) -> bool:
    """Whether a character is one of _WORD's."""
    return c.isalnum() and not c.isdecimal()


def train(docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE_DOCUMENTS, modulus: int = 4, remainder: int = 2) -> dict:
    """Learn from at most `sample` documents of each label that are not held out, each with its whole text.

    Words are counted and sentences reduced to their listed words by the executors; what reaches the driver is bounded by the sample and MOST_WORDS.
    """
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(modulus, remainder)).select("doc_id", F.col("toxic").cast("long").alias("toxic")).distinct()
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    parts = [known.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for k in (0, 1)]
    rows = written(sampled_texts(docs, parts[0].union(parts[1])), "toxic-sample")
    have = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if not have.get(1) or not have.get(0):
        return {"words": {}, "b": -20.0, "leak": min(counts.get(1, 0) / max(sum(counts.values()), 1), 1 - 1e-9)}
    words = listed_words(rows.select("toxic", "text"), have[1], have[0])
    while True:
        got = sorted(bags(rows, words).collect(), key=lambda r: (r["doc_id"], r["toxic"]))
        y = np.array([r["toxic"] for r in got], np.int64)
        w, b, leak = fit([r["found"] for r in got], np.array([r["plain"] for r in got], float), y, np.array([counts[k] / have[k] for k in y.tolist()], float), len(words))
        kept = [k for k in range(len(words)) if w[k] > LEAST_WEIGHT]
        if len(kept) == len(words):
            return {"words": {words[k]: float(w[k]) for k in kept}, "b": b, "leak": leak}
        words = [words[k] for k in kept]  # without the weak ones b and the leak are fitted anew


def score(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, score, predicted, and the sentences with listed words: start and end in code points, and score."""

    def run(batches):
        scorer = Scorer(model)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
        for batch in batches:
            out = [scorer(t) for t in batch.column(1).to_pylist()]
            s = np.array([x[0] for x in out], np.float64)
            spans = pa.array([[{"start": a, "end": b, "score": p} for a, b, p in x[1]] for x in out], kind)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32)), spans], names=["doc_id", "score", "predicted", "sentences"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double, predicted int, sentences array<struct<start:int,end:int,score:double>>")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return score(docs, train(docs, table(spark, sf_dir, "labels"))).select("doc_id", held_out(4, 2), "score", "predicted", "sentences")

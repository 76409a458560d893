"""Quality classifier: histogram gradient-boosted trees over document statistics.

`statistics` turns every whole text into a fixed row of numbers; `fit_trees` boosts depth-limited trees on
histograms of binned statistics; the ensemble is flattened into three arrays, which `score_rows` walks with numpy.

Defined results: a null text counts as empty; empty texts get the score of all-zero statistics; repeated rows are scored
each; an empty table gives an empty result; without a usable label every score is 0.5. Only text and the key are read,
so extra columns, whatever their names, change nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.llm import npwords
from factloom.llm.common import documents, held_out, sampled_texts, table, trimmed

#: Bound of the training sample: labelled documents, the first by a hash of the id.
SAMPLE_DOCUMENTS = 20_000
TREES, DEPTH, BINS, RATE, L2, MIN_ROWS = 80, 4, 64, 0.12, 2.0, 20

_KINDS = ("upper", "lower", "digit", "space", "newline", "stop", "bang", "pipe", "symbol", "high")
_KIND = np.full(256, 8, np.uint8)
_KIND[65:91], _KIND[97:123], _KIND[48:58] = 0, 1, 2
_KIND[[32, 9, 11, 12, 13]], _KIND[10], _KIND[128:] = 3, 4, 9
_KIND[[ord(c) for c in ".,;:'\"?()-"]], _KIND[ord("!")], _KIND[ord("|")] = 5, 6, 7
NAMES = ("log_bytes", "log_words", "word_bytes", *_KINDS, "distinct_words", "top_word", "same_next", "distinct_triples", "log_lines", "distinct_lines", "line_bytes", "symbols_a_word", "upper_a_word")


def _runs(sorted_values: np.ndarray) -> tuple[int, int]:
    """Distinct values and the length of the longest run."""
    if not len(sorted_values):
        return 0, 0
    edges = np.flatnonzero(np.concatenate(([True], sorted_values[1:] != sorted_values[:-1], [True])))
    return len(edges) - 1, int(np.diff(edges).max())


def statistics(column: pa.Array) -> np.ndarray:
    """One row of len(NAMES) numbers for each text."""
    data, offsets = npwords.utf8(column)
    out = np.zeros((len(offsets) - 1, len(NAMES)), np.float64)
    for i, j in npwords.blocks(offsets):
        own, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        kind = _KIND[own]
        size = np.diff(at).astype(np.float64)
        counts = np.zeros((j - i, len(_KINDS)))
        for k in range(len(_KINDS)):
            run = np.concatenate(([0], np.cumsum(kind == k)))
            counts[:, k] = run[at[1:]] - run[at[:-1]]
        words, first = npwords.word_hashes(own, at)
        n_words = np.diff(first).astype(np.float64)
        triples = npwords.mix(words[:-2] * np.uint64(3) + npwords.mix(words[1:-1] * np.uint64(5) + words[2:])) if len(words) > 2 else words[:0]
        same = np.concatenate(([0], np.cumsum(words[1:] == words[:-1]))) if len(words) > 1 else np.zeros(1, np.int64)
        more = np.zeros((j - i, 6))
        for d in range(j - i):
            a, b = first[d], first[d + 1]
            if b > a:
                distinct, top = _runs(np.sort(words[a:b]))
                more[d, 0], more[d, 1], more[d, 2] = distinct / (b - a), top / (b - a), (same[b - 1] - same[a]) / (b - a)
                if b - a > 2:
                    more[d, 3] = _runs(np.sort(triples[a : b - 2]))[0] / (b - a - 2)
            lines = [x for x in own[at[d] : at[d + 1]].tobytes().split(b"\n") if x]
            if lines:
                more[d, 4], more[d, 5] = len(set(lines)) / len(lines), sum(map(len, lines)) / len(lines)
        per = np.maximum(size, 1)[:, None]
        letters = counts[:, 0] + counts[:, 1] + counts[:, 9]
        out[i:j] = np.column_stack([np.log1p(size), np.log1p(n_words), letters / np.maximum(n_words, 1), counts / per, more[:, :4], np.log1p(counts[:, 4]), more[:, 4:], counts[:, 8] / np.maximum(n_words, 1), counts[:, 0] / np.maximum(n_words, 1)])
    return out


def fit_trees(x: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """Start value, split features, split values and leaves of the boosted trees; heap order inside each tree."""
    if not len(y):
        return 0.0, np.zeros((0, 1), np.int64), np.zeros((0, 1)), np.zeros((0, 2))
    base = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    start, inner = float(np.log(base / (1 - base))), 2**DEPTH - 1
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.column_stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)])
    raw = np.full(len(y), start)
    features, values, leaves = np.zeros((TREES, inner), np.int64), np.full((TREES, inner), np.inf), np.zeros((TREES, inner + 1))
    for t in range(TREES):
        p = 1 / (1 + np.exp(-raw))
        g, h = y - p, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for depth in range(DEPTH):
            first, width = 2**depth - 1, 2**depth
            best = np.full(width, 1e-6)
            for f, e in enumerate(edges):
                key = (node - first) * BINS + binned[:, f]
                sums = [np.bincount(key, w, width * BINS).reshape(width, BINS).cumsum(1) for w in (g, h, None)]
                (gl, hl, nl), (ga, ha, na) = sums, [s[:, -1:] for s in sums]
                gain = gl**2 / (hl + L2) + (ga - gl) ** 2 / (ha - hl + L2) - ga**2 / (ha + L2)
                gain[(nl < MIN_ROWS) | (na - nl < MIN_ROWS)] = 0
                gain = gain[:, : len(e)]
                if not gain.shape[1]:
                    continue
                at = gain.argmax(1)
                for k in np.flatnonzero(gain[np.arange(width), at] > best):
                    best[k] = gain[k, at[k]]
                    features[t, first + k], values[t, first + k] = f, e[at[k]]
            node = 2 * node + 1 + (x[np.arange(len(y)), features[t, node]] > values[t, node])
        node -= inner
        gs, hs = np.bincount(node, g, inner + 1), np.bincount(node, h, inner + 1)
        leaves[t] = RATE * gs / (hs + L2)
        raw += leaves[t, node]
    return start, features, values, leaves


def score_rows(model: tuple[float, np.ndarray, np.ndarray, np.ndarray], x: np.ndarray) -> np.ndarray:
    start, features, values, leaves = model
    raw, rows = np.full(len(x), start), np.arange(len(x))
    for f, v, leaf in zip(features, values, leaves, strict=True):
        node = np.zeros(len(x), np.int64)
        for _ in range(DEPTH):
            node = 2 * node + 1 + (x[rows, f[node]] > v[node])
        raw += leaf[node - len(f)]
    return 1 / (1 + np.exp(-raw))


def _with_statistics(batches):
    for batch in batches:
        x = statistics(batch.column(1))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(NAMES)).cast(pa.list_(pa.float64()))], names=["y", "x"])


def train(docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE_DOCUMENTS, modulus: int = 3, remainder: int = 1):
    """Learn from at most `sample` labelled documents (null labels aside) that are not held out; of rows that share an id one is learned from."""
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(modulus, remainder)).select("doc_id", "quality").distinct()
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(sample)
    rows = sampled_texts(docs, known).select(F.col("quality").cast("double").alias("y"), "text")
    got = rows.mapInArrow(trimmed(_with_statistics), "y double, x array<double>").toArrow()
    y = got.column("y").to_numpy()
    x = np.array(got.column("x").to_pylist(), np.float64).reshape(len(y), len(NAMES))
    order = np.lexsort((*x.T, y))  # the same trees however the rows arrive
    return fit_trees(x[order], y[order])


def score(docs: DataFrame, model) -> DataFrame:
    """doc_id, score and predicted (1 from 0.5 on) of every text."""

    def run(batches):
        for batch in batches:
            s = score_rows(model, statistics(batch.column(1))) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32))], names=["doc_id", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(trimmed(run), "doc_id long, score double, predicted int")


def keep_good(docs: DataFrame, model) -> DataFrame:
    """The rows of docs, all columns, whose text is predicted 1."""
    names = docs.columns
    at = names.index("text")

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(score_rows(model, statistics(batch.column(at))) >= 0.5))

    return docs.mapInArrow(trimmed(run), docs.schema)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = train(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", held_out(3, 1), "score", "predicted")


"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text is built. A text is parsed from left to right into the longest pieces that
occur in the labelled text (walking the automaton, and starting again from its root where no transition exists). Each piece costs
log2(size of the labelled text) bits; the language with the fewest bits, that is the fewest normalised phrases, wins. The walk runs for all
languages and many stretches of text at once, one byte at a time, over one transition table. Texts are parsed whole, in stretches
of STRETCH bytes, each of which starts at the root.

Defined results: null texts and texts without a letter are `und` with score 0; ties go to the smaller language code; repeated rows
are predicted each; an empty table gives an empty result; with no labelled text all is `und`. Only text and the key are read in prediction.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factloom.llm import npwords
from factloom.llm.common import documents, held_out, sampled_texts

#: Bounds of the training sample: documents of each language (first by a hash of the id), bytes of labelled text of each.
SAMPLE_DOCUMENTS, SAMPLE_BYTES = 150, 40_000
#: Bytes of a stretch that is learned from; parts in which the ids of a language are ranked.
PIECE, SALTS = 256, 64
STRETCH, LANES, SYMBOLS = 2048, 1 << 14, 96


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a sequence; state 0 is the root."""
    go: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in codes:
        new = len(go)
        go.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in go[p]:
            go[p][c] = new
            p = link[p]
        if p >= 0:
            q = go[p][c]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                copy = len(go)
                go.append(dict(go[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and go[p].get(c) == q:
                    go[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return go


def plain(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased UTF-8 bytes with runs of ASCII non-letters left as they are; offsets of the texts."""
    return npwords.utf8(pc.utf8_lower(pc.fill_null(column.cast(pa.large_string()), "")))


def _codes(samples: dict[str, bytes]) -> np.ndarray:
    """The code of each byte: 0 for ASCII non-letters, then the commonest letters' bytes; the last code is for all others."""
    counts = np.bincount(np.frombuffer(b"".join(samples.values()), np.uint8), minlength=256)
    letter = np.zeros(256, bool)
    letter[97:123], letter[128:] = True, True
    kept = [int(b) for b in np.argsort(-counts, kind="stable") if letter[b] and counts[b]][: SYMBOLS - 2]
    code = np.where(letter, len(kept) + 1, 0).astype(np.uint8)
    code[kept] = np.arange(1, len(kept) + 1)
    return code


class Parser:
    """Counts phrases of stretches of text in all languages at once."""

    def __init__(self, samples: dict[str, bytes]):
        self.names = sorted(samples)
        self.code = _codes(samples)
        width = int(self.code.max(initial=0)) + 2
        tables, self.roots, self.bits, base = [], [], [], 0
        for name in self.names:
            go = suffix_automaton(self.code[np.frombuffer(samples[name], np.uint8)].tolist())
            # one state more: no phrase is open, as at the start and after a byte that the sample lacks
            table = np.full((len(go) + 1, width), -1, np.int64)
            for s, to in enumerate(go):
                table[s, list(to)] = list(to.values())
            fresh = np.where(table[0] >= 0, table[0], len(go))  # the phrase ends; the byte starts the next one
            missing = table < 0
            table = np.where(missing, fresh[None, :], table)
            tables.append(((table + base) * width * 2 + missing).astype(np.int32))
            self.roots.append((base + len(go)) * width)
            self.bits.append(np.log2(max(2, len(samples[name]))))
            base += len(go) + 1
        self.table = np.concatenate(tables).ravel() if tables else np.zeros(0, np.int32)
        self.bits = np.array(self.bits)

    def phrases(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Phrases of codes[start:end] for each stretch (row) and language (column)."""
        n, k = len(starts), len(self.names)
        out = np.zeros((n, k), np.int32)
        order = np.argsort(starts - ends, kind="stable")
        for i in range(0, n, LANES):
            own = order[i : i + LANES]
            size = ends[own] - starts[own]
            if not len(size) or not size[0]:
                continue
            grid = np.zeros((int(size[0]), len(own)), np.int32)
            inside = np.arange(int(size[0]))[:, None] < size[None, :]
            grid[inside] = codes[(starts[own][None, :] + np.arange(int(size[0]))[:, None])[inside]]
            active = np.searchsorted(-size, -np.arange(int(size[0])), "left")
            for lang in range(k):
                state, count = np.full(len(own), self.roots[lang], np.int32), np.zeros(len(own), np.int32)
                for step, m in enumerate(active.tolist()):
                    got = self.table.take(state[:m] + grid[step, :m])
                    count[:m] += got & 1
                    np.right_shift(got, 1, out=state[:m])
                out[own, lang] = count
        return out

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        """Language and score of each text; the score is the language's share of 2**-bits over all languages."""
        data, offsets = plain(column)
        n, k = len(offsets) - 1, len(self.names)
        letters = pc.fill_null(pc.match_substring_regex(column.cast(pa.large_string()), r"\p{L}"), False).to_numpy(zero_copy_only=False)
        if not k:
            return ["und"] * n, np.zeros(n)
        bits = np.zeros((n, k))
        for i, j in npwords.blocks(offsets, 4 << 20):
            sizes = np.diff(offsets[i : j + 1])
            parts = -(-sizes // STRETCH)
            doc = np.repeat(np.arange(j - i), parts)
            nth = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
            starts = offsets[i + doc] - offsets[i] + nth * STRETCH
            ends = np.minimum(starts + STRETCH, offsets[i + doc + 1] - offsets[i])
            got = self.phrases(self.code[data[offsets[i] : offsets[j]]], starts, ends)
            for lang in range(k):
                bits[i:j, lang] = np.bincount(doc, got[:, lang], j - i) * self.bits[lang]
        best = bits.argmin(1)
        score = 1 / np.exp2(np.minimum(0, bits.min(1)[:, None] - bits)).sum(1)
        return [self.names[b] if ok else "und" for b, ok in zip(best.tolist(), letters, strict=True)], np.where(letters, score, 0.0)


def _stretches(most: int):
    """lang, nth, h and bytes of a text's stretches of PIECE bytes, the first `most` of them by a hash over the whole text."""

    def run(batches):
        for batch in batches:
            for lang, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                low = text.lower().encode()
                hashed = [(zlib.crc32(b"%d:%d" % (doc_id, i)), i) for i in range(-(-len(low) // PIECE))]
                own = heapq.nsmallest(most, hashed)
                cols = [[lang] * len(own), list(range(len(own))), [h for h, _ in own], [low[i * PIECE : (i + 1) * PIECE] for _, i in own]]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.int32(), pa.int64(), pa.binary()), strict=True)], names=["lang", "nth", "h", "piece"])

    return run


def train(docs: DataFrame, *, sample: int = SAMPLE_DOCUMENTS, size: int = SAMPLE_BYTES, modulus: int = 4, remainder: int = 2) -> dict[str, bytes]:
    """Labelled text of each language: `size` bytes at most, in stretches from all over at most `sample` documents, in turns, so that a language with few
    documents takes more of each. The ids are chosen first, without the text; of rows that share an id and a language one is learned from."""
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & ~held_out(modulus, remainder)).select("doc_id", "lang").distinct()
    rank = lambda *more: F.row_number().over(Window.partitionBy("lang", *more).orderBy(F.xxhash64("doc_id"), "doc_id"))
    # first within salts, so that a common language's ids aren't ranked by one task
    salted = known.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))).withColumn("rank", rank("salt")).where(F.col("rank") <= sample)
    ids = salted.withColumn("rank", rank()).where(F.col("rank") <= sample).select("doc_id", "lang")
    most = -(-2 * size // PIECE)
    rows = sampled_texts(docs.where(F.col("text").isNotNull()), ids, "lang").select("lang", F.col("doc_id").cast("long"), "text").mapInArrow(_stretches(most), "lang string, nth int, h long, piece binary")
    turn = F.row_number().over(Window.partitionBy("lang").orderBy("nth", "h", "piece"))
    out: dict[str, list[bytes]] = {}
    for r in rows.withColumn("turn", turn).where(F.col("turn") <= most).orderBy("lang", "turn").collect():  # twice `size` bytes a language at most
        out.setdefault(r["lang"], []).append(bytes(r["piece"]))
    return {lang: b" ".join(pieces)[:size] for lang, pieces in out.items()}


_parsers: dict[int, Parser] = {}


def parser_of(samples: dict[str, bytes]) -> Parser:
    """One parser for each Python process, however many tasks it runs."""
    key = hash(tuple(sorted(samples.items())))
    if key not in _parsers:
        _parsers.clear()
        _parsers[key] = Parser(samples)
    return _parsers[key]


def predict(docs: DataFrame, samples: dict[str, bytes]) -> DataFrame:
    """doc_id, lang_pred and score of every text."""

    def run(batches):
        parser = parser_of(samples)
        for batch in batches:
            names, score = parser.predict(batch.column(1)) if batch.num_rows else ([], np.zeros(0))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return predict(docs, train(docs)).select("doc_id", held_out(4, 2), "lang_pred", "score")

"""Token ids in ORC files: run-length encoded integers, row indexes, and Bloom filters on document ids.

Documents are dealt to ranges of doc_id and sorted, so the files, in the order of their numbers, hold the ids in ascending doc_id order;
each range becomes a file of stripes that can be read in parallel, and statistics or Bloom filters prune stripes for a look-up by id.

Defined results: a null text is empty and yields the end id alone; null ids come first; equal ids are ordered by the text (its first 64
characters, then a hash) and are documents of their own; an empty table gives an empty result. The tokenizer's special strings inside a text are ordinary text. Extra columns are left out.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factloom.llm import npwords
from factloom.llm.common import caches, documents, give_back, new_path, written

END = 0
#: Bytes encoded in one call, units whose ids a process keeps, places of its table: bounds of its memory.
CALL_BYTES, KEPT_UNITS, PLACES = 500_000, 300_000, 1 << 21
#: Byte values of the second hash of a unit.
_SECOND = np.random.default_rng(77).integers(1, 1 << 63, 256, dtype=np.uint64)
_tokenizers: dict[str, object] = {}


def tokenizer(path: str):
    if path not in _tokenizers:
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.encode_special_tokens = True
        _tokenizers[path] = t
    return _tokenizers[path]


def cuts_hold(path: str) -> bool:
    """Whether texts may be cut as Encoder does: byte-level pre-tokenizer with its own pattern, no normalizer, no post-processor."""
    import json

    with open(path, encoding="utf-8") as f:
        told = json.load(f)
    own = told.get("pre_tokenizer") or {}
    plain = own.get("type") == "ByteLevel" and own.get("use_regex", True) and not own.get("add_prefix_space", True)
    return plain and told.get("normalizer") is None and told.get("post_processor") is None


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91], _LETTER[97:123] = True, True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".,;:!?"]] = True


def _odd(data: np.ndarray) -> np.ndarray:
    """Places with blanks next to each other, or with a blank outside ASCII."""
    white = _WHITE[data]
    out = white.copy()
    out[:-1] &= white[1:]
    out[-1:] = False
    for k in np.flatnonzero(np.isin(data, (0xC2, 0xE1, 0xE2, 0xE3))).tolist() if (data >= 0xC2).any() else ():
        c = data[k : k + 3].tobytes()
        if c[:2] in (b"\xc2\x85", b"\xc2\xa0") or (c[0] > 0xC2 and c.decode(errors="replace").isspace()):
            out[k] = True
    return out


class Encoder:
    """Ids of whole texts. The tokenizer's own cutting always ends a piece before a single blank, on both sides of a single line end and between
    a letter and a stop, so texts are cut there and each distinct unit is encoded once for many texts: all new ones as one text, whose ids are
    dealt out by their bytes. Units are known by two hashes of 64 and 32 bits and their length, in a table with one place for each; one that finds its place
    taken is encoded again each time. Texts with blanks next to each other, at an end, or outside ASCII are encoded as they are, and so are all
    texts where the tokenizer cuts in another way (cuts_hold)."""

    def __init__(self, path: str):
        self.tokenizer, self.cuts = tokenizer(path), cuts_hold(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.bytes[i] = len(token)  # byte-level: a letter for each byte
        self._clear()

    def _clear(self) -> None:
        self.keys, self.seconds, self.codes = np.zeros(PLACES, np.uint64), np.zeros(PLACES, np.uint32), np.zeros(PLACES, np.int32)
        self.starts, self.lengths, self.pool = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.sizes = np.zeros(1, np.int64)[:0]

    def _learn(self, units: list[bytes]) -> None:
        """Number the units on. Those with a blank before them are joined as they are, others by line ends; blanks are texts of their own."""
        kinds = [0 if len(u) > 1 and u[0] == 32 else 2 if _WHITE[u[0]] else 1 for u in units]
        starts, lengths, pools, at = np.zeros(len(units), np.int64), np.zeros(len(units), np.int64), [self.pool], len(self.pool)
        for kind, between in ((0, 0), (1, 1), (2, 0)):
            own = [i for i, k in enumerate(kinds) if k == kind]
            for part in ([[i] for i in own] if kind == 2 else [own] if own else []):
                text = (b"\n" * between).join([units[i] for i in part]).decode()
                ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int32)
                size = np.fromiter((len(units[i]) for i in part), np.int64, len(part))
                first = np.cumsum(size + between) - size - between
                ends = np.cumsum(self.bytes[ids])
                a, z = np.searchsorted(ends, first, "right"), np.searchsorted(ends, first + size) + 1
                starts[part], lengths[part] = at + a, z - a
                pools.append(ids)
                at += len(ids)
        self.starts, self.lengths, self.pool = np.concatenate([self.starts, starts]), np.concatenate([self.lengths, lengths]), np.concatenate(pools)

    def _numbers(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of each unit."""
        hashes, seconds, size = npwords.run_hashes(data, starts, ends), (npwords.run_hashes(data, starts, ends, _SECOND) >> np.uint64(32)).astype(np.uint32), ends - starts
        place = (hashes & np.uint64(PLACES - 1)).astype(np.int64)
        codes = self.codes[place]
        # a place that no unit has taken yet has the key 0 and the length 0
        known = (self.keys[place] == hashes) & (self.seconds[place] == seconds)
        known[known] = self.sizes[codes[known]] == size[known]
        miss = np.flatnonzero(~known)
        if len(miss):
            order = miss[np.lexsort((size[miss], seconds[miss], hashes[miss]))]
            new = np.ones(len(order), bool)
            new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (seconds[order][1:] != seconds[order][:-1]) | (size[order][1:] != size[order][:-1])
            at, raw, first = order[new], data.tobytes(), len(self.starts)
            self._learn([raw[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)])
            self.sizes = np.concatenate([self.sizes, size[at]])
            codes[order] = first + np.cumsum(new) - 1
            self.keys[place[at]], self.seconds[place[at]] = hashes[at], seconds[at]
            # of several new units with one place, the one whose key was written last owns it
            own = (self.keys[place[at]] == hashes[at]) & (self.seconds[place[at]] == seconds[at])
            self.codes[place[at[own]]] = first + np.flatnonzero(own)
        return codes

    def __call__(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, with END after each text, and the number of each text's ids."""
        if len(self.starts) > KEPT_UNITS:
            self._clear()
        data, offsets = npwords.utf8(column)
        n_texts, size = len(offsets) - 1, np.diff(offsets)
        full = np.flatnonzero(size)
        odd = np.zeros(n_texts, bool)
        odd[full] = _WHITE[data[offsets[:-1][full]]] | _WHITE[data[offsets[1:][full] - 1]]
        odd[np.searchsorted(offsets, np.flatnonzero(_odd(data)), "right") - 1] = True
        odd |= not self.cuts
        cut = _WHITE[data]
        line = cut & (data != 32)
        cut[1:] |= line[:-1] | (_STOP[data[1:]] & _LETTER[data[:-1]])
        cut[offsets[:-1][full]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(data))[: len(starts)]
        text = np.searchsorted(offsets, starts, "right") - 1
        usual = ~odd[text]
        starts, ends, text = starts[usual], ends[usual], text[usual]
        codes = self._numbers(data, starts, ends)
        n = self.lengths[codes]
        total = np.concatenate(([0], np.cumsum(n)))
        flat = self.pool[np.repeat(self.starts[codes] - total[:-1], n) + np.arange(int(total[-1]))]
        at = total[np.searchsorted(text, np.arange(n_texts + 1))]
        which, raw = np.flatnonzero(odd).tolist(), data.tobytes()
        whole = dict(zip(which, self.tokenizer.encode_batch_fast([raw[offsets[i] : offsets[i + 1]].decode() for i in which], add_special_tokens=False), strict=True))
        end, parts, sizes = np.array([END], np.int32), [], []
        for i in range(n_texts):
            own = np.array(whole[i].ids, np.int32) if i in whole else flat[at[i] : at[i + 1]]
            parts += [own, end]
            sizes.append(len(own) + 1)
        return (np.concatenate(parts) if parts else np.zeros(0, np.int32)), np.array(sizes, np.int64)


_encoders: dict[str, Encoder] = {}
caches.append(_encoders)


def encoder(path: str) -> Encoder:
    """One encoder for each Python process, however many tasks it runs."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encode(docs: DataFrame, path: str | None) -> DataFrame:
    """doc_id and ids (with the end id) of each text, in the order of docs."""

    def run(batches):
        of = encoder(path or default_path())
        for batch in batches:
            for i, j in npwords.blocks(npwords.utf8(batch.column(1))[1], CALL_BYTES):
                flat, sizes = of(batch.column(1).slice(i, j - i))
                offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["doc_id", "ids"])
                del flat
                give_back()

    return docs.mapInArrow(run, "doc_id long, ids array<int>")


def write(docs: DataFrame, path: str, tokenizer_path: str | None = None) -> None:
    """Encode every text and write the ids in ascending doc_id order to ORC files in `path`."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.substring("text", 1, 64).alias("begin"), F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("nth"))
    # equal ids are dealt to several files too
    order = [F.col("doc_id").asc_nulls_first(), F.col("begin").asc(), F.col("h").asc(), F.col("nth").asc()]
    out = encode(rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text"), tokenizer_path).write.option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01")
    out.option("orc.row.index.stride", "10000").option("orc.create.index", "true").option("orc.stripe.size", str(16 << 20)).option("compression", "zstd").orc(path)


def read(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """doc_id and ids from the files; with doc_ids only theirs, for which stripes are pruned by statistics and Bloom filters."""
    rows = spark.read.schema("doc_id long, ids array<int>").orc(path)
    return rows if doc_ids is None else rows.where(F.col("doc_id").isin(*doc_ids))


def _digests(batches):
    for batch in batches:
        ids = batch.column(2)
        offsets, values = ids.offsets.to_numpy(), np.ascontiguousarray(ids.values.to_numpy(), "<u4")
        crc = [zlib.crc32(values[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), pa.array(np.diff(offsets).astype(np.int64)), pa.array(crc, pa.int64())], names=["file", "doc_id", "row", "n_tokens", "ids_crc32"])


def file_number(name: str) -> int:
    """The place of a file among the files: names are padded to five digits only."""
    return int(name.split("-")[1])


def digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, from the files.

    `row` keeps the order inside a file; starts are sums inside a file on top of the totals of the files before it (one number a file reaches the driver).
    """
    rows = read(spark, path).select(F.col("_metadata.file_name").alias("file"), "doc_id", "ids", F.monotonically_increasing_id().alias("row"))
    small = written(rows.mapInArrow(_digests, "file string, doc_id long, row long, n_tokens long, ids_crc32 long"), "token-digests")
    totals = {r["file"]: r["n"] for r in small.groupBy("file").agg(F.sum("n_tokens").alias("n")).collect()}
    before, at = [], 0
    for name in sorted(totals, key=file_number):
        before.append((name, at))
        at += totals[name]
    base = F.broadcast(spark.createDataFrame(before, "file string, base long"))
    own = F.sum("n_tokens").over(Window.partitionBy("file").orderBy(F.col("doc_id").asc_nulls_first(), "row").rowsBetween(Window.unboundedPreceding, -1))
    return small.withColumn("own", F.coalesce(own, F.lit(0))).join(base, "file").select("doc_id", (F.col("base") + F.col("own")).alias("start"), "n_tokens", "ids_crc32")


def op5_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "token-ids")
    write(documents(spark, sf_dir), path)
    return digests(spark, path)

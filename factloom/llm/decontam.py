"""Benchmark decontamination by latent semantic retrieval.

1. A first pass over every text counts in how many documents each of FEATURES hashed words stands, and how often.
2. Texts are cut into passages; their TF-IDF matrix A is never built. A sparse random sign matrix R gives Y = A R passage by passage, and
   B = A' Y is summed over all passages of all texts (randomised SVD with one power step): its left singular vectors are the latent axes.
   Both sums are added up on the executors, FAN tasks' at a time, in as many levels as the number of tasks asks for.
3. Benchmark items are projected as queries, texts as windows, in two sizes (SCALES) for shorter and longer queries; a cosine of LEAST_COSINE makes a
   candidate (no limit to their number). Only windows that can pass are projected: an item's rarest words are its anchors, and a part that
   shares LEAST_SHARE of the item has at least `need` anchors close together; where they aren't, no subsequence is long enough. A cosine is diluted by the
   words around a short or common passage, so the places that the anchors leave are candidates as well where the cosine misses them.
   Items of common words only, whose anchors would leave too many places, are bounded by all their words (Bound).
4. A candidate's stretch of text is compared with the item: the longest common subsequence of 64-bit word hashes is computed; the item's answer (its last
   sentence) must be found in it as well, unless nearly the whole item is. Paraphrases that keep most words in order are caught so.

The benchmark is the stated query set: it is searched for in parts of at most PART_ITEMS items and PART_CHARACTERS characters, each against all texts.

Defined results: null and empty texts and items match nothing; items under LEAST_WORDS words match where all of them stand one after the other; repeated documents or items give a
match each; an empty table gives an empty result. Extra columns are left out. Words are runs of bytes other than blanks, with A-Z lower-cased and the
punctuation around them cut off.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.llm import npwords
from factloom.llm.common import documents, table, tree_sum, trimmed, written

FEATURES, RANK = 1 << 13, 64
#: Words of a window, words from one window to the next, longest query: shorter windows for short queries.
SCALES = ((32, 8, 24), (64, 16, 48))
#: Items that are looked for together where anchors leave too many places; the share of places that is too many, and that for which no more anchors are taken.
GROUP, MOST_PLACES, FEW_PLACES = 32, 0.003, 1e-5
#: Items and characters of the benchmark that are sent to the tasks at a time.
PART_ITEMS, PART_CHARACTERS = 5_000, 4_000_000
BLOCK, PASSAGE = 8, 64
#: Features in a larger share of the documents have the weight COMMON_WEIGHT only.
COMMON, COMMON_WEIGHT = 0.06, 0.1
LEAST_COSINE, LEAST_SHARE, LEAST_ANSWER, WHOLE_SHARE, LEAST_WORDS = 0.3, 0.6, 0.5, 0.8, 5
#: Punctuation becomes blank before words are hashed, so that it doesn't separate equal words.
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[[ord(c) for c in ".,;:!?\"'()[]|*#$%&"]] = 32


def tokens(column: pa.Array):
    """For blocks of texts: the first text and one past the last, 64-bit word hashes, offsets of the texts."""
    data, offsets = npwords.utf8(column)
    for i, j in npwords.blocks(offsets):
        words, at = npwords.word_hashes(_PLAIN[data[offsets[i] : offsets[j]]], offsets[i : j + 1] - offsets[i])
        yield i, j, words, at


def _counted(batches):
    """One row: the task's number of documents, documents with each feature, occurrences of each feature."""
    counts, often, n = np.zeros(FEATURES), np.zeros(FEATURES), 0
    for batch in batches:
        for i, j, words, at in tokens(batch.column(0)):
            feature = (words & np.uint64(FEATURES - 1)).astype(np.int64)
            often += np.bincount(feature, minlength=FEATURES)
            for a in range(i, j, 256):
                z = min(a + 256, j)
                own = slice(at[a - i], at[z - i])
                seen = np.zeros((z - a) * FEATURES, bool)
                seen[np.repeat(np.arange(z - a), np.diff(at[a - i : z - i + 1])) * FEATURES + feature[own]] = True
                counts += seen.reshape(z - a, FEATURES).sum(0)
            n += j - i
    yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([np.concatenate(([n], counts, often)).tobytes()], pa.binary())], names=["axis", "sums"])


def features(words: np.ndarray) -> np.ndarray:
    """Feature of each word; a word that only repeats the one before it gets the feature FEATURES, which has no weight."""
    out = (words & np.uint64(FEATURES - 1)).astype(np.int64)
    out[1:][words[1:] == words[:-1]] = FEATURES
    return out


def _pieces(at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of pieces of `size` words inside texts (a text's last may be shorter), and the text of each."""
    parts = -(-np.diff(at) // size)
    text = np.repeat(np.arange(len(parts)), parts)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(parts) - parts, parts)
    return at[text] + nth * size, text


def _signs() -> tuple[np.ndarray, np.ndarray]:
    """The sparse random matrix R: a column and a sign for each feature."""
    rng = np.random.default_rng(31)
    return rng.integers(0, RANK, FEATURES), rng.choice([-1.0, 1.0], FEATURES).astype(np.float32)


def _range_rows(weight: np.ndarray):
    """Sums B = A' (A R) over the passages of a task, a row of bytes for each axis."""

    def run(batches):
        column, sign = _signs()
        column, own_weight = np.append(column, 0), np.append(sign * weight[:FEATURES], 0.0)
        total = np.zeros((RANK, FEATURES))
        for batch in batches:
            for _, _, words, at in tokens(batch.column(0)):
                own = features(words)
                if not len(own):
                    continue
                starts, _ = _pieces(at, PASSAGE)
                passage = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(own))))
                y = np.bincount(passage * RANK + column[own], own_weight[own], len(starts) * RANK).reshape(-1, RANK)
                y = np.ascontiguousarray((y / np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-9)).T)
                for c in range(RANK):
                    total[c] += np.bincount(own, y[c].take(passage), FEATURES + 1)[:FEATURES]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(RANK), pa.int32()), pa.array([(row * weight[:FEATURES]).tobytes() for row in total], pa.binary())], names=["axis", "sums"])

    return run


def latent_axes(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(FEATURES + 1) x RANK matrix that takes features to latent coordinates, from all texts, and the share of all words that each feature has."""
    got = tree_sum(texts.mapInArrow(trimmed(_counted), "axis int, sums binary")).get(0, np.zeros(1 + 2 * FEATURES))
    n, counts, often = got[0], got[1 : FEATURES + 1], got[FEATURES + 1 :]
    weight = np.where(counts > COMMON * n, COMMON_WEIGHT, np.log((n + 1) / (counts + 1))).astype(np.float32)
    sums = tree_sum(texts.mapInArrow(trimmed(_range_rows(weight)), "axis int, sums binary"))
    b = np.stack([sums[c] for c in sorted(sums)], 1) if sums else np.zeros((FEATURES, RANK))
    return axes_of(b, weight), often / max(often.sum(), 1)


def axes_of(b: np.ndarray, weight: np.ndarray) -> np.ndarray:
    u, s, _ = np.linalg.svd(b, full_matrices=False)
    # axes in units of their spread: a few very frequent words would else be all that counts
    axes = weight[:, None] * u / np.sqrt(np.maximum(s, s[:1].max(initial=1e-9) * 1e-6))[None, :]
    return np.concatenate([axes, np.zeros((1, axes.shape[1]))]).astype(np.float32)


class Vocabulary:
    """Numbers of known words."""

    def __init__(self, words: np.ndarray):
        self.words = np.unique(words)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.words & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def places(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the known ones among `words` (one dimension), and their numbers."""
        at = np.flatnonzero(self.maybe[(words & np.uint64((1 << 20) - 1)).astype(np.int64)])
        number = np.minimum(np.searchsorted(self.words, words[at]), len(self.words) - 1)
        ok = self.words[number] == words[at] if len(self.words) else np.zeros(0, bool)
        return at[ok], number[ok]

    def ids(self, words: np.ndarray) -> np.ndarray:
        """The number of each word; one past the last for unknown ones."""
        out = np.full(words.size, len(self.words), np.int32)
        at, number = self.places(words.ravel())
        out[at] = number
        return out.reshape(words.shape)


class Bound:
    """Places where a few items of about one length may stand, with none left out.

    A part of 1.5 times an item's length (see Items.best) that passes lies in one of the windows looked at here, a run of blocks. The distinct words
    that window and item share, with the item's repeats, bound their longest common subsequence; where that is enough, the subsequence itself is computed.
    """

    def __init__(self, words: list[np.ndarray]):
        n = np.array([len(w) for w in words])
        self.step = 1 + (int(n.min()) >= 32)
        self.size = -(-(int(n.max()) * 3 // 2 + 2 + BLOCK * self.step - 1) // BLOCK)
        self.vocabulary = Vocabulary(np.concatenate(words))
        vocabulary = self.vocabulary.words
        self.limbs = -(-n // 64)
        self.first = np.cumsum(self.limbs) - self.limbs
        self.shared = np.zeros((len(vocabulary) + 1, self.limbs.sum()), np.uint64)
        self.places = np.zeros((self.limbs.sum(), len(vocabulary) + 1), np.uint64)
        for own, at in zip(words, self.first.tolist(), strict=True):
            for k, w in enumerate(self.vocabulary.ids(np.unique(own)).tolist()):
                self.shared[w, at + k // 64] |= np.uint64(1 << k % 64)
            for k, w in enumerate(self.vocabulary.ids(own).tolist()):
                self.places[at + k // 64, w] |= np.uint64(1 << k % 64)
        self.least = np.ceil(LEAST_SHARE * n - 1e-9).astype(np.int64)
        self.need = self.least - (n - np.array([len(np.unique(w)) for w in words]))

    def windows(self, words: np.ndarray, beyond: np.ndarray):
        """Arrays of start block and item of the windows whose longest common subsequence with the item is long enough; words: rows of BLOCK each."""
        ids = self.vocabulary.ids(words)
        ids[beyond] = len(self.shared) - 1
        seen = self.shared.take(ids[:, 0], axis=0)
        for k in range(1, BLOCK):
            seen |= self.shared.take(ids[:, k], axis=0)
        have = 1
        while have < self.size:  # words of `have` blocks from each block on, then of more
            more = min(have, self.size - have)
            if len(seen) > more:
                seen[:-more] |= seen[more:].copy()
            have += more
        count = np.bitwise_count(seen[:: self.step])
        if len(self.limbs) < count.shape[1]:
            count = np.add.reduceat(count, self.first, axis=1, dtype=np.int64)
        start, item = np.nonzero(count >= self.need)
        start *= self.step
        flat = np.append(ids.ravel(), np.full(self.size * BLOCK, len(self.shared) - 1, np.int32))
        for limbs in np.unique(self.limbs[item]).tolist():
            those = np.flatnonzero(self.limbs[item] == limbs)
            for i in range(0, len(those), 1 << 13):
                a, b = start[those[i : i + (1 << 13)]], item[those[i : i + (1 << 13)]]
                ok = self.common(flat, a * BLOCK, b, limbs) >= self.least[b]
                yield a[ok], b[ok]

    def common(self, ids: np.ndarray, start: np.ndarray, item: np.ndarray, limbs: int) -> np.ndarray:
        """Length of the longest common subsequence of each window and item, a row of bits for all at once."""
        width = self.places.shape[1]
        rows, places = [(self.first[item] + k) * width for k in range(limbs)], self.places.ravel()
        v = [np.full(len(start), ~np.uint64(0)) for _ in range(limbs)]
        for k in range(self.size * BLOCK):
            word = ids.take(start + k)
            carry = None
            for j in range(limbs):
                u = v[j] & places.take(rows[j] + word)
                total = v[j] + u
                over = total < u if limbs > 1 else None
                if carry is not None:
                    total += carry
                    over |= total < carry
                v[j] = total | (v[j] ^ u)
                carry = over.astype(np.uint64) if limbs > 1 else None
        return sum(np.bitwise_count(~x).astype(np.int64) for x in v)


class Items:
    """Benchmark items: words, queries in latent space, answers, anchors, and masks for the longest common subsequence."""

    def __init__(self, rows: list[tuple[int, str]], axes: np.ndarray, rates: np.ndarray | None = None):
        self.axes, self.ids, self.words, self.answers, self.masks = axes, [], [], [], []
        queries: list[list] = [[] for _ in SCALES]
        for item_id, text in rows:
            words = next((w for _, _, w, _ in tokens(pa.array([text]))), np.zeros(0, np.uint64))
            if len(words) < LEAST_WORDS:
                continue
            last = [x for x in re.split(r"(?<=[.!?])\s+|\n+", text.strip()) if x][-1]
            answer = next((w for _, _, w, _ in tokens(pa.array([last]))), words[:0])
            masks: dict[int, int] = {}
            for i, w in enumerate(words.tolist()):
                masks[w] = masks.get(w, 0) | 1 << i
            scale = next((k for k, (_, _, most) in enumerate(SCALES) if len(words) <= most), len(SCALES) - 1)
            most = SCALES[scale][2]
            for i in (*range(0, len(words) - most, most), max(0, len(words) - most)):  # longer items are several queries, the last one their last words
                q = axes[features(words[i : i + most])].sum(0)
                queries[scale].append((q / max(float(np.linalg.norm(q)), 1e-9), len(self.ids)))
            self.ids.append(item_id)
            self.words.append(words)
            self.answers.append(answer)
            self.masks.append(masks)
        self.queries = [np.array([x[0] for x in own], np.float32).reshape(-1, RANK) for own in queries]
        self.item_of = [np.array([x[1] for x in own], np.int64) for own in queries]
        self._choose(np.full(FEATURES, 1 / FEATURES) if rates is None else np.maximum(rates, 0.1 / FEATURES))

    def _choose(self, rates: np.ndarray) -> None:
        """The anchors of each item: the rarest of its words, as many as leave the fewest places where `need` of them stand in a part."""
        n_items = len(self.ids)
        self.size, self.need = np.zeros(n_items, np.int64), np.ones(n_items, np.int64)
        self.least = np.array([int(np.ceil(LEAST_SHARE * len(w) - 1e-9)) for w in self.words], np.int64)
        common, anchors = [], []
        for item, words in enumerate(self.words):
            n, size = len(words), len(words) + len(words) // 2 + 2
            own, times = np.unique(words, return_counts=True)
            rate = rates[(own & np.uint64(FEATURES - 1)).astype(np.int64)]
            order = np.argsort(rate, kind="stable")
            need = self.least[item] - (n - np.cumsum(times[order]))
            mean = size * np.cumsum(rate[order])
            # Chernoff's bound on the chance of `need` anchors in a part
            chance = np.where(need < 1, 1.0, np.where(mean < need, np.exp(need - mean + need * np.log(np.maximum(mean, 1e-300) / np.maximum(need, 1))), 1.0))
            few = np.flatnonzero(chance <= FEW_PLACES)
            k = int(few[0]) if len(few) else int(np.argmin(chance))
            self.size[item], self.need[item] = size, max(1, need[k])
            if chance[k] > MOST_PLACES:
                common.append(item)
            else:
                anchors += [(int(w), item) for w in own[order[: k + 1]].tolist()]
        order = sorted(common, key=lambda i: len(self.words[i]))
        self.bounds = [(np.array(order[k : k + GROUP]), Bound([self.words[i] for i in order[k : k + GROUP]])) for k in range(0, len(order), GROUP)]
        word, item = np.array([a for a, _ in anchors], np.uint64), np.array([i for _, i in anchors], np.int64)
        self.anchors = Vocabulary(word)
        number = self.anchors.ids(word)
        order = np.argsort(number, kind="stable")
        self.anchor_items = item[order]
        self.anchor_first = np.searchsorted(number[order], np.arange(len(self.anchors.words) + 1))

    def lcs(self, item: int, words: np.ndarray) -> int:
        """Length of the longest common subsequence, a row of bits at a time."""
        masks, full = self.masks[item], (1 << len(self.words[item])) - 1
        v = full
        for w in words.tolist():
            if (m := masks.get(w)) is not None:
                u = v & m
                v = ((v + u) | (v - u)) & full
        return len(self.words[item]) - v.bit_count()

    def stretches(self, words: np.ndarray, at: np.ndarray):
        """Arrays of text, item, first word and one past the last: all parts that share enough with an item lie in one of these, with none left out."""
        place, number = self.anchors.places(words)
        times = self.anchor_first[number + 1] - self.anchor_first[number]
        item = self.anchor_items[np.repeat(self.anchor_first[number] - np.cumsum(times) + times, times) + np.arange(int(times.sum()))]
        place = np.repeat(place, times)
        order = np.argsort(item * len(words) + place, kind="stable")
        place, item = place[order], item[order]
        text = np.searchsorted(at, place, "right") - 1
        first = np.arange(len(place))
        last = first + self.need[item] - 1
        first = first[last < len(place)]
        last = last[: len(first)] if len(first) == len(last) else last[first]
        ok = (item[first] == item[last]) & (text[first] == text[last]) & (place[last] - place[first] < self.size[item[first]])
        first, last = first[ok], last[ok]
        text, item, size = text[first], item[first], self.size[item[first]]
        out = [(text, item, np.maximum(at[text], place[last] - size + 1), np.minimum(at[text + 1], place[first] + size))]
        if self.bounds and len(words):
            starts, of = _pieces(at, BLOCK)
            places = starts[:, None] + np.arange(BLOCK)
            beyond = places >= at[of + 1][:, None]  # a text's last row is filled up
            rows = words.take(np.minimum(places, len(words) - 1))
            for items, bound in self.bounds:
                for a, b in bound.windows(rows, beyond):
                    out.append((of[a], items[b], starts[a], np.minimum(starts[a] + bound.size * BLOCK, at[of[a] + 1])))
        text, item, low, high = (np.concatenate(x) for x in zip(*out, strict=True))
        order = np.lexsort((low, item, text))
        text, item, low, high = text[order], item[order], low[order], high[order]
        new = np.flatnonzero(np.concatenate(([True], (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (low[1:] > high[:-1])))[: len(text)])
        return text[new], item[new], low[new], np.maximum.reduceat(high, new) if len(new) else high

    def candidates(self, words: np.ndarray, at: np.ndarray, found=None):
        """Arrays of text, item, start word and cosine: windows near the stretches that are found, whose cosine with a query of the item reaches LEAST_COSINE."""
        text, item, low, high = self.stretches(words, at) if found is None else found
        if not len(text):
            return
        pairs, own = np.unique(text * len(self.ids) + item), np.append(features(words), FEATURES)
        for (size, stride, _), queries, item_of in zip(SCALES, self.queries, self.item_of, strict=True):
            if not len(queries):
                continue
            # windows start at multiples of the stride in their text
            a, z = np.maximum(0, (low - at[text] - size) // stride + 1), (high - at[text] - 1) // stride + 1
            n = np.maximum(0, z - a)
            start, one = np.unique(np.repeat(at[text] + a * stride, n) + (np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)) * stride, return_index=True)
            of = np.repeat(text, n)[one]
            for k in range(0, len(start), 1024):
                first, text_of = start[k : k + 1024], of[k : k + 1024]
                places = first[:, None] + np.arange(size)
                beyond = places >= at[text_of + 1][:, None]
                places[beyond] = len(words)
                vectors = self.axes[own[places]]
                vectors[beyond] = 0
                windows = vectors.sum(1)
                windows /= np.maximum(np.linalg.norm(windows, axis=1, keepdims=True), 1e-9)
                cosine = windows @ queries.T
                w, q = np.nonzero(cosine >= LEAST_COSINE)
                ok = np.isin(text_of[w] * len(self.ids) + item_of[q], pairs)
                yield text_of[w[ok]], item_of[q[ok]], first[w[ok]], cosine[w[ok], q[ok]]

    def cosine(self, item: int, words: np.ndarray) -> float:
        q, w = self.axes[features(self.words[item])].sum(0), self.axes[features(words)].sum(0)
        return float(q @ w / max(float(np.linalg.norm(q) * np.linalg.norm(w)), 1e-9))

    def matches(self, words: np.ndarray, at: np.ndarray):
        """(text, item, cosine, common, start, end) for texts of a block."""
        if not len(words) or not self.ids:
            return
        found = self.stretches(words, at)
        cosines: dict[tuple[int, int], float] = {}
        for x in self.candidates(words, at, found):
            for t, i, value in zip(x[0].tolist(), x[1].tolist(), x[3].tolist(), strict=True):
                cosines[t, i] = max(value, cosines.get((t, i), -1.0))
        for t, own, first, last in zip(*(x.tolist() for x in found), strict=True):
            part = words[first:last]
            if self.lcs(own, part) < self.least[own]:
                continue
            if got := self.best(own, part):
                start = first - int(at[t])
                value = cosines.get((t, own))
                yield t, own, self.cosine(own, part[got[1] : got[2]]) if value is None else value, got[0], start + got[1], start + got[2]

    def best(self, item: int, stretch: np.ndarray) -> tuple[int, int, int] | None:
        """Common subsequence, start and end of the part of 1.5 times the item's length that has the longest one and passes, or None."""
        n, out = len(self.words[item]), None
        size = n + n // 2 + 2
        for step in dict.fromkeys((max(1, n // 4), 1)):  # every place, where none of the wider steps passes
            for i in range(0, max(1, len(stretch) - size + 1 + n // 4), step):
                part = stretch[i : i + size]
                common = self.lcs(item, part)
                if common >= LEAST_SHARE * n and (out is None or common > out[0]) and (common >= WHOLE_SHARE * n or np.isin(self.answers[item], part).mean() >= LEAST_ANSWER):
                    out = common, i, i + len(part)
            if out:
                return out
        return out


def _search(sent):
    def run(batches):
        rows, axes, rates, short = sent.value
        items = Items(rows, axes, rates)
        for batch in batches:
            out, ids = [], batch.column(0).to_pylist()
            for i, _, words, at in tokens(batch.column(1)):
                for t, item, cosine, common, start, end in items.matches(words, at):
                    out.append((ids[i + t], items.ids[item], cosine, common / len(items.words[item]), start, end))
                out += [(ids[i + t], *found) for t, found in _verbatim(short, words, at)]
            yield _rows(out)

    return run


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int32(), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["doc_id", "item_id", "cosine", "lcs_share", "start_word", "end_word"])


def short_items(rows: list[tuple[int, str]]) -> list[tuple[int, list[int]]]:
    """Items of fewer than LEAST_WORDS words, and the hashes of these."""
    own = [(item_id, next((w for _, _, w, _ in tokens(pa.array([text]))), np.zeros(0, np.uint64)).tolist()) for item_id, text in rows]
    return [(item_id, w) for item_id, w in own if 0 < len(w) < LEAST_WORDS]


def _verbatim(items: list[tuple[int, list[int]]], words: np.ndarray, at: np.ndarray):
    """The first place of each item of `items` in each text that has its words one after the other."""
    for item_id, own in items:
        place = np.flatnonzero(words == np.uint64(own[0]))
        text = np.searchsorted(at, place, "right") - 1
        ok = place + len(own) <= at[text + 1]
        place, text = place[ok], text[ok]
        for k, w in enumerate(own[1:], 1):
            ok = words[place + k] == np.uint64(w)
            place, text = place[ok], text[ok]
        text, first = np.unique(text, return_index=True)
        for t, p in zip(text.tolist(), (place[first] - at[text]).tolist(), strict=True):
            yield t, (item_id, 1.0, 1.0, p, p + len(own))


def benchmark_parts(benchmark: DataFrame):
    """The items in parts that fit the driver and every task, however long the benchmark is."""
    rows = benchmark.where("text is not null and item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), "text")
    part, size = [], 0
    for r in rows.orderBy("item_id", "text").toLocalIterator():
        if part and (len(part) >= PART_ITEMS or size + len(r["text"]) > PART_CHARACTERS):
            yield part
            part, size = [], 0
        part.append((r["item_id"], r["text"]))
        size += len(r["text"])
    yield part


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document and benchmark item it holds: doc_id, item_id, cosine, lcs_share, and the words between which it was found."""
    own = docs.where("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    axes, rates = latent_axes(own.select("text"))
    form, found, parts = "doc_id long, item_id long, cosine double, lcs_share double, start_word int, end_word int", None, 0
    for part in benchmark_parts(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast((part, axes, rates, short_items(part)))
        one = own.mapInArrow(trimmed(_search(sent)), form)
        if parts:  # a long benchmark: each part's matches are written before the next part is searched for
            one, found = written(one, "matches"), written(found, "matches") if parts == 1 else found
        found, parts = one if found is None else found.unionByName(one), parts + 1
    # a stretch that two groups of windows reach is one match
    best = F.max_by(F.struct("cosine", "lcs_share", "start_word", "end_word"), F.struct("lcs_share", -F.col("start_word"))).alias("m")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "m.*")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))

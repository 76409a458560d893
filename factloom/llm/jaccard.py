"""N-gram Jaccard join with a count-vector R-tree.

A document's set is its distinct five-word shingles, hashed to 64 bits. The hashes are dealt to GROUPS groups, and the numbers of a set's shingles in the
groups are its point. Two sets share at most the sum of the smaller coordinates, so pairs whose sum is too small for the wanted similarity are left out
unseen, and whole tree nodes with them (their largest coordinates bound all points below); pairs that survive are verified on the sets.

For unrelated texts of one length all points lie about equally far apart and a tree over the whole corpus prunes nothing above its leaves. So the corpus is first
cut into blocks, exactly: of two sets of similarity 0.8 each has at most a fifth of its shingles outside the other, so in whatever order all shingles are put
the first one they share is among the first fifth (and one) of both. A block is the sets that hold one shingle there; no link is lost. Within the blocks:

1. documents with equal sets become one class, represented by its smallest id; blocks with the same members are one;
2. shingles that more than HOT classes have in their first fifth (passages that many texts share), and those so frequent in the second fifth of these texts, come
   last in the order, so that they make blocks only of sets that consist of little else;
3. a block's tree is searched for its smallest member; found pairs are verified, and linked members become components. Blocks over LEAF members are searched in
   parts of their own, to each of which the smallest member goes;
4. blocks whose members are still in several components are joined tree by tree, without the pairs of one component: a leaf is at most about LEAF members of similar
   size, pairs of leaves that their bounds rule out go before any point is read, and each pair that is left is a task's work; texts that share a passage meet in a
   block for each of its shingles, so members carry their first blocks and a pair is made in the first that both carry;
5. components of all verified links give the result.

Defined results: null, empty and word-less texts have no shingle, link with nothing and are components of their own; rows that repeat a doc_id are rows of one
document; rows with a null doc_id have a null component and link nothing; an empty table gives an empty result. Extra columns are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.llm import npwords
from factloom.llm.common import BROADCAST_KEYS, documents, keep_keys, trimmed, written
from factloom.llm.components import components

SHINGLE, NUMERATOR, DENOMINATOR = 5, 80, 100
GROUPS = 128
#: Members of a block that are searched in one task, points in a node of the tree.
LEAF, NODE = 1024, 32
#: Shingles to a group of the finer points of long texts.
FINE = 4
#: Blocks that a member carries with it where blocks are joined tree by tree, and what stands for none.
CARRIED, NO_BLOCK = 16, (1 << 63) - 1
#: Classes that make a shingle frequent; the most frequent shingles that are sent to the tasks.
HOT, MOST_HOT = 256, 500_000


def first_shingles(hashes: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """The first fifth (and one) of a set's sorted hashes, of which the frequent ones come last."""
    n = len(hashes)
    take = n - -(-n * NUMERATOR // DENOMINATOR) + 1
    if len(hot):
        last = np.isin(hashes, hot)
        hashes = np.concatenate([hashes[~last], hashes[last]])
    return hashes[:take]


def next_shingles(hashes: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """As many hashes after the first ones, by hash: what comes in where first ones are frequent."""
    take = len(first_shingles(hashes, hot))
    return hashes[take : 2 * take]


def points(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The count vector of each set."""
    doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
    flat = doc * GROUPS + (hashes & np.uint64(GROUPS - 1)).astype(np.int64)
    return np.bincount(flat, minlength=(len(at) - 1) * GROUPS).astype(np.uint32).reshape(-1, GROUPS)


def fine_points(hashes: np.ndarray, at: np.ndarray) -> list[bytes | None]:
    """The count vectors of sets of many shingles with more groups, at most FINE shingles to a group: a power of two times GROUPS. Sets that GROUPS suffice for: null.

    Large counts are alike by chance, so for long texts GROUPS rule nothing out. A vector is folded to fewer groups by adding its parts.
    """
    out: list[bytes | None] = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        groups = GROUPS
        while b - a > FINE * groups:
            groups *= 2
        out.append(packed(np.bincount((hashes[a:b] & np.uint64(groups - 1)).astype(np.int64), minlength=groups)) if groups > GROUPS else None)
    return out


def folded(blob: bytes, groups: int, width: int) -> np.ndarray:
    point = np.frombuffer(blob, {1: np.uint8, 2: np.uint16, 4: np.uint32}[width])
    return point.reshape(-1, groups).sum(0, dtype=np.int64)


def packed(point: np.ndarray) -> bytes:
    """A point in as few bytes a coordinate as its largest one needs."""
    top = int(point.max(initial=0))
    return point.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32).tobytes()


def unpacked(column: pa.Array | list) -> np.ndarray:
    """Points from their bytes, whose number tells how wide a coordinate is."""
    rows = column if isinstance(column, list) else column.to_pylist()
    width = np.array([len(r) // GROUPS for r in rows], np.int64)
    out = np.zeros((len(rows), GROUPS), np.int64 if width.max(initial=1) > 2 else np.int32)
    for w, kind in ((1, np.uint8), (2, np.uint16), (4, np.uint32)):
        own = np.flatnonzero(width == w)
        if len(own):
            out[own] = np.frombuffer(b"".join([rows[i] for i in own.tolist()]), kind).reshape(-1, GROUPS)
    return out


def _sets(column: pa.Array):
    data, offsets = npwords.utf8(column)
    for i, j in npwords.blocks(offsets, npwords.BLOCK_BYTES // 4):
        words, first = npwords.word_hashes(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        yield i, j, *npwords.shingles(words, first, SHINGLE)


def _listed(hashes: np.ndarray, at: np.ndarray, hot: np.ndarray, pick=first_shingles) -> pa.ListArray:
    own = [pick(hashes[a:b], hot) if b > a else hashes[:0] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
    ends = np.concatenate(([0], np.cumsum([len(x) for x in own]))).astype(np.int32)
    flat = np.concatenate(own) if own else hashes[:0]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))


def _sketches(batches):
    """doc_id, number of shingles, digest of the set (two longs), first shingles, point and finer point (bytes)."""
    for batch in batches:
        for i, j, hashes, at in _sets(batch.column(1)):
            n = np.diff(at)
            full = np.flatnonzero(n)
            one, two = np.zeros(j - i, np.uint64), np.zeros(j - i, np.uint64)
            if len(full):
                starts = at[:-1][full]
                one[full], two[full] = np.add.reduceat(npwords.mix(hashes), starts), np.bitwise_xor.reduceat(npwords.mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)), starts)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(n.astype(np.int64)), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), _listed(hashes, at, hashes[:0]), pa.array([packed(x) for x in points(hashes, at)], pa.binary()), pa.array(fine_points(hashes, at), pa.binary())], names=["doc_id", "n", "d1", "d2", "first", "point", "fine"])


def _picked(pick, sent=None):
    """id, number of shingles and what `pick` takes of them, given the frequent ones that were sent."""

    def run(batches):
        hot = np.zeros(0, np.uint64) if sent is None else sent.value
        for batch in batches:
            for i, j, hashes, at in _sets(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(np.diff(at).astype(np.int64)), _listed(hashes, at, hot, pick)], names=["id", "n", "first"])

    return run


def _full_sets(batches):
    """id, number of shingles, the set's hashes."""
    for batch in batches:
        for i, j, hashes, at in _sets(batch.column(1)):
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(np.diff(at)), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(hashes.view(np.int64)))], names=["id", "n", "hashes"])


def possible(shared: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether `shared` common shingles of sets with `sizes` in all suffice."""
    return shared * (NUMERATOR + DENOMINATOR) >= sizes * NUMERATOR


class RTree:
    """Points packed into nodes by size, then by their first coordinates, with the largest coordinates and the least size of each node."""

    def __init__(self, counts: np.ndarray, sizes: np.ndarray):
        self.counts, self.sizes = counts, sizes.astype(np.int64)
        order = np.argsort(self.sizes, kind="stable")
        slab = max(NODE, int(np.sqrt(len(order) * NODE)))
        order = np.concatenate([s[np.lexsort((self.counts[s, 1], self.counts[s, 0]))] for s in np.split(order, range(slab, len(order), slab))]) if len(order) else order
        self.nodes = [order[i : i + NODE] for i in range(0, len(order), NODE)]
        self.high = np.array([self.counts[n].max(0) for n in self.nodes]).reshape(len(self.nodes), -1)
        self.least = np.array([self.sizes[n].min() for n in self.nodes], np.int64)

    def search(self, node: np.ndarray, counts: np.ndarray, sizes: np.ndarray):
        """For the points (counts, sizes) of a query node: the rows of query and of tree that may be similar."""
        top = np.minimum(self.high, counts.max(0)[None, :]).sum(1, dtype=np.int64)
        for k in np.flatnonzero(possible(top, self.least + sizes.min())):
            own = self.nodes[k]
            shared = np.minimum(counts[:, None, :], self.counts[own][None, :, :]).sum(2, dtype=np.int64)
            a, b = np.nonzero(possible(shared, sizes[:, None] + self.sizes[own][None, :]))
            yield node[a], own[b]


def tree_join(ids: np.ndarray, groups: np.ndarray, sizes: np.ndarray, counts: np.ndarray, parts: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of ids that may be similar, of different groups; with two parts only pairs across them."""
    tree, out = RTree(counts, sizes), []
    for node in tree.nodes:
        for a, b in tree.search(node, tree.counts[node], tree.sizes[node]):
            keep = (ids[a] < ids[b]) & (groups[a] != groups[b])
            if parts[0] != parts[-1] or len(np.unique(parts)) > 1:
                keep &= parts[a] != parts[b]
            out += zip(ids[a][keep].tolist(), ids[b][keep].tolist(), strict=True)
    return out


def _groups(batches, width: int):
    """Whole groups of rows that agree in their first `width` columns, from batches of sorted rows: a table of some groups, and their starts."""
    left = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch]) if left is None else pa.concat_tables([left, pa.Table.from_batches([batch])])
        keys = [table.column(k).to_numpy() for k in range(width)]
        new = np.ones(table.num_rows, bool)
        new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
        starts = np.flatnonzero(new)
        if len(starts) > 1:
            yield table.slice(0, int(starts[-1])), starts[:-1]
        left = table.slice(int(starts[-1]))
    if left is not None and left.num_rows:
        yield left, np.zeros(1, np.int64)


def _searched(batches):
    """Pairs (a, b) of each block's members and its smallest member, b, that the block's tree doesn't rule out. Rows: key, part, other (0: the smallest), id, n, point."""
    for table, starts in _groups(batches, 2):
        ids, sizes, other = (table.column(c).to_numpy() for c in ("id", "n", "other"))
        counts = unpacked(table.column("point").to_pylist())
        ends = np.append(starts[1:], len(ids))
        small = ends - starts <= NODE
        # a tree of one node: its points are tested at once, for all such blocks
        head = np.repeat(starts, ends - starts)
        own = np.repeat(small, ends - starts) & (other > 0) & (other[head] == 0)
        at = np.flatnonzero(own)
        at = at[near(counts, sizes, at, head[at])]
        a, b = [ids[at]], [ids[head[at]]]
        for i, j in zip(starts[~small].tolist(), ends[~small].tolist(), strict=True):
            if other[i]:
                continue
            tree = RTree(counts[i + 1 : j], sizes[i + 1 : j])
            for _, found in tree.search(np.zeros(1, np.int64), counts[i : i + 1], sizes[i : i + 1]):
                a.append(ids[i + 1 : j][found])
                b.append(np.full(len(found), ids[i]))
        a, b = np.concatenate(a), np.concatenate(b)
        keep = a != b
        yield pa.RecordBatch.from_arrays([pa.array(a[keep], pa.int64()), pa.array(b[keep], pa.int64())], names=["a", "b"])


def near(counts: np.ndarray, sizes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of the pairs of rows (a, b) their sizes and points don't rule out."""
    out = np.minimum(sizes[a], sizes[b]) * DENOMINATOR >= np.maximum(sizes[a], sizes[b]) * NUMERATOR
    left = np.flatnonzero(out)
    for k in range(0, len(left), 1 << 16):
        at = left[k : k + (1 << 16)]
        out[at] = possible(np.minimum(counts[a[at]], counts[b[at]]).sum(1, dtype=np.int64), sizes[a[at]] + sizes[b[at]])
    return out


def _paired(batches):
    """Pairs (a, b) of members of a block of one node that are of different groups and not ruled out, for many blocks at once. Rows: key, id, grp, n, point."""
    for table, starts in _groups(batches, 1):
        ids, grps, sizes = (table.column(c).to_numpy() for c in ("id", "grp", "n"))
        counts = unpacked(table.column("point").to_pylist())
        ends = np.append(starts[1:], len(ids))
        after = np.repeat(ends, ends - starts) - np.arange(len(ids)) - 1
        a = np.repeat(np.arange(len(ids)), after)
        b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(after) - after, after)
        keep = (grps[a] != grps[b]) & (ids[a] != ids[b])
        a, b = a[keep], b[keep]
        keep = near(counts, sizes, a, b)
        x, y = ids[a[keep]], ids[b[keep]]
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y), pa.int64()), pa.array(np.maximum(x, y), pa.int64())], names=["a", "b"])


def _leaves(batches):
    """key, slab, salt, least size and largest coordinates of each leaf, and its members. Rows: key, slab, salt, id, grp, n, point."""
    names = ["key", "slab", "salt", "least", "high", "ids", "grps", "sizes", "points", "blocks"]
    for table, starts in _groups(batches, 3):
        counts, sizes = unpacked(table.column("point").to_pylist()), table.column("n").to_numpy()
        ids, grps = table.column("id").to_numpy(), table.column("grp").to_numpy()
        ends = np.append(starts[1:], len(ids))
        keys = [table.column(c).to_numpy()[starts] for c in ("key", "slab", "salt")]
        offsets = pa.array(np.append(starts, len(ids)).astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (ids, grps, sizes)]
        high = np.maximum.reduceat(counts, starts)
        blobs = [packed(counts[i:j]) for i, j in zip(starts.tolist(), ends.tolist(), strict=True)]
        carried = pc.list_flatten(table.column("blocks").combine_chunks()).to_numpy().reshape(-1, CARRIED)
        carried = pa.array([carried[i:j].tobytes() for i, j in zip(starts.tolist(), ends.tolist(), strict=True)], pa.binary())
        yield pa.RecordBatch.from_arrays([*map(pa.array, keys), pa.array(np.minimum.reduceat(sizes, starts)), pa.array([packed(x) for x in high], pa.binary()), *lists, pa.array(blobs, pa.binary()), carried], names=names)


def _near_leaves(batches):
    """Pairs of leaves that their bounds don't rule out."""
    for batch in batches:
        if not batch.num_rows:
            continue
        get = lambda c: batch.column(batch.schema.get_field_index(c))  # noqa: E731, B023
        x, y = unpacked(get("high").to_pylist()), unpacked(get("high2").to_pylist())
        ok = pa.array(possible(np.minimum(x, y).sum(1, dtype=np.int64), get("least").to_numpy() + get("least2").to_numpy()))
        names = ["key", "slab", "salt", "slab2", "salt2"]
        yield pa.RecordBatch.from_arrays([get(c).filter(ok) for c in names], names=names)


def met_here(key: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which pairs of members with the first blocks x and y (rows, sorted) a block has to make: those whose first common one it is, or that carry none in common."""
    out = np.ones(len(x), bool)
    for k in range(0, len(x), 1 << 14):
        i, j = x[k : k + (1 << 14)], y[k : k + (1 << 14)]
        first = np.where((i[:, :, None] == j[:, None, :]).any(2), i, NO_BLOCK).min(1)
        out[k : k + (1 << 14)] = (first == NO_BLOCK) | (first == key)
    return out


def _joined(batches):
    """Pairs (a, b) of members of two leaves (or one) that the trees don't rule out and that are of different groups, in the block that has to make them."""
    for batch in batches:
        for row in batch.to_pylist():
            one, two = ([np.array(row[f"{c}{k}"], np.int64) for c in ("ids", "grps", "sizes")] for k in ("", "2"))
            x, y = (_matrix(row[f"points{k}"], len(row[f"ids{k}"])) for k in ("", "2"))
            if (row["slab"], row["salt"]) == (row["slab2"], row["salt2"]):
                pairs = tree_join(*one, x, np.zeros(len(x)))
            else:
                pairs = tree_join(*[np.concatenate(z) for z in zip(one, two, strict=True)], np.concatenate([x, y]), np.repeat([0, 1], [len(x), len(y)]))
            a, b = np.array([p[0] for p in pairs], np.int64), np.array([p[1] for p in pairs], np.int64)
            ids, carried = np.concatenate([one[0], two[0]]), np.frombuffer(row["blocks"] + row["blocks2"], np.int64).reshape(-1, CARRIED)
            order = np.argsort(ids, kind="stable")
            at = lambda c: order[np.searchsorted(ids, c, sorter=order)]  # noqa: E731, B023
            keep = met_here(row["key"], carried[at(a)], carried[at(b)])
            yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], names=["a", "b"])


def _matrix(blob: bytes, n: int) -> np.ndarray:
    """A leaf's points."""
    width = len(blob) // (n * GROUPS)
    return np.frombuffer(blob, {1: np.uint8, 2: np.uint16, 4: np.uint32}[width]).reshape(n, GROUPS).astype(np.int64 if width > 2 else np.int32)


def _by_fine_points(batches):
    """The pairs that their finer points don't rule out."""
    for batch in batches:
        a, b, na, nb, fa, fb = (c.to_pylist() for c in batch.columns)
        keep = []
        for x, y, m, n in zip(fa, fb, na, nb, strict=True):
            size = [GROUPS, GROUPS]
            for k, own in enumerate((m, n)):
                while own > FINE * size[k]:
                    size[k] *= 2
            groups = min(size)
            shared = int(np.minimum(folded(x, groups, len(x) // size[0]), folded(y, groups, len(y) // size[1])).sum())
            keep.append(bool(possible(shared, m + n)))
        keep = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])


def verified(pairs: DataFrame, own: DataFrame, fine: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar, each once. Finer points come first (fine: id, n, fine), then the sets, which are made only of texts that a pair names."""
    side = lambda c: fine.select(F.col("id").alias(c), F.col("n").alias(f"n{c}"), F.col("fine").alias(f"f{c}"))
    near = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", "fa", "fb").mapInArrow(_by_fine_points, "a long, b long").distinct()
    pairs = written(near, "pairs")
    ids = written(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "paired")
    texts = keep_keys(own.where("doc_id is not null"), ids, "doc_id", ids.count())
    sets = written(texts.mapInArrow(trimmed(_full_sets), "id long, n long, hashes array<long>"), "sets")
    full = lambda c: sets.select(F.col("id").alias(c), F.col("n").alias(f"n{c}"), F.col("hashes").alias(f"h{c}"))
    shared = F.size(F.array_intersect("ha", "hb"))
    found = pairs.join(full("a"), "a").join(full("b"), "b")
    return found.where(shared * (NUMERATOR + DENOMINATOR) >= (F.col("na") + F.col("nb")) * NUMERATOR).select("a", "b").distinct()


def block_keys(own: DataFrame, classes: DataFrame) -> DataFrame:
    """id, n, key: the first shingles of every class, in an order that puts frequent ones last.

    Frequent are shingles that more than HOT classes have among their first ones by hash, and those that more than HOT of these classes have next: more of the same
    passages. Whatever is called frequent, the order is one for all texts, so blocks stay exact.
    """
    keys = classes.select(F.col("rep").alias("id"), "n", F.explode("first").alias("key"))
    often = lambda df: df.groupBy("key").agg(F.count("*").alias("members")).where(F.col("members") > HOT)
    hot = written(often(keys).select("key"), "hot")
    n_hot = hot.count()
    if not n_hot:
        return keys
    with_hot = lambda some, n: written(keep_keys(keys, some, "key", n).select(F.col("id").alias("doc_id")).distinct(), "with-hot")
    touched = with_hot(hot, n_hot)
    texts = keep_keys(own.where("doc_id is not null"), touched, "doc_id", touched.count())
    counted = often(texts.mapInArrow(trimmed(_picked(next_shingles)), "id long, n long, first array<long>").select(F.explode("first").alias("key")))
    counted = written(counted.unionByName(hot.withColumn("members", F.lit(HOT + 1).cast("long"))).groupBy("key").agg(F.max("members").alias("members")), "counted")
    least, n_hot = HOT, counted.count()
    while n_hot > MOST_HOT:  # only the most frequent ones go to the tasks; the blocks of the others are larger, and as exact
        least *= 2
        n_hot = counted.where(F.col("members") > least).count()
    hot = counted.where(F.col("members") > least).select("key")
    sent = own.sparkSession.sparkContext.broadcast(np.sort(np.array([r["key"] for r in hot.collect()], np.int64).view(np.uint64)))
    touched = with_hot(hot, n_hot)
    n_touched = touched.count()
    texts = keep_keys(own.where("doc_id is not null"), touched, "doc_id", n_touched)
    again = written(texts.mapInArrow(trimmed(_picked(first_shingles, sent)), "id long, n long, first array<long>").where("n > 0"), "again").select("id", "n", F.explode("first").alias("key"))
    ids = touched.select(F.col("doc_id").alias("id"))
    ids = F.broadcast(ids) if n_touched <= BROADCAST_KEYS else ids
    return keys.join(ids, "id", "left_anti").unionByName(again)


def links(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sketches (doc_id, n, rep: the smallest id with the same set), and enough verified links (a, b) between reps to connect all that are linked."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketches = written(own.mapInArrow(trimmed(_sketches), "doc_id long, n long, d1 long, d2 long, first array<long>, point binary, fine binary"), "sketches")
    classes = sketches.where("n > 0 and doc_id is not null").groupBy("d1", "d2", "n").agg(F.min_by(F.struct("first", "point", "fine"), "doc_id").alias("s"), F.min("doc_id").alias("rep"))
    classes = written(classes.select("d1", "d2", "n", "rep", "s.*"), "classes")
    keys = block_keys(own, classes)
    # blocks with the same members are one
    heads = keys.groupBy("key").agg(F.min("id").alias("head"), F.count("*").alias("members"), F.sum(F.shiftright(F.xxhash64("id"), 28)).alias("s"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("x"))
    blocks = written(heads.where("members > 1").groupBy("members", "s", "x").agg(F.min("key").alias("key"), F.min("head").alias("head")).select("key", "head", "members"), "blocks")
    members = written(keys.join(F.broadcast(blocks) if blocks.count() <= BROADCAST_KEYS // 8 else blocks, "key"), "members")
    dots = classes.select(F.col("rep").alias("id"), "n", "point")
    fine = classes.select(F.col("rep").alias("id"), "n", F.coalesce("fine", "point").alias("fine"))
    parts = F.ceil(F.col("members") / LEAF).cast("int")
    here = F.when(F.col("id") == F.col("head"), F.sequence(F.lit(0), parts - 1)).otherwise(F.array(F.pmod(F.xxhash64("id"), parts).cast("int")))
    rows = members.withColumn("part", F.explode(here)).withColumn("other", (F.col("id") != F.col("head")).cast("int")).join(dots, ["id", "n"])
    rows = rows.select("key", "part", "other", "id", "n", "point").repartition("key", "part").sortWithinPartitions("key", "part", "other")
    stars = written(rows.mapInArrow(trimmed(_searched), "a long, b long").distinct(), "stars")
    first = written(verified(stars, own, fine), "links")
    # what the smallest members have not settled: blocks of three or more with several components
    labels = components(first)
    more = members.where("members > 2").join(labels, "id", "left").select("key", "id", "n", "members", F.coalesce("label", "id").alias("grp"))
    open_ = more.groupBy("key").agg(F.min("grp").alias("low"), F.max("grp").alias("high")).where("low <> high").select("key")
    more = keep_keys(more, open_, "key", open_.count()).join(dots, ["id", "n"])
    small = more.where(F.col("members") <= NODE).select("key", "id", "grp", "n", "point").repartition("key").sortWithinPartitions("key")
    found = small.mapInArrow(trimmed(_paired), "a long, b long").unionByName(leaf_pairs(more.where(F.col("members") > NODE))).distinct()
    second = verified(found.join(stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti"), own, fine)
    reps = classes.select("d1", "d2", "n", "rep")
    return sketches.select("doc_id", "n", "d1", "d2").join(reps, ["d1", "d2", "n"], "left").select("doc_id", "n", "rep"), written(first.unionByName(second), "links")


def leaf_pairs(rows: DataFrame) -> DataFrame:
    """Pairs (a, b) of members of one block and different groups that the trees don't rule out; rows: key, id, n, grp, point.

    Sizes of similar sets differ by a quarter at most, so a leaf (a slab of sizes, dealt by salts to about LEAF members) meets leaves of its own slab and the next.
    """
    # the first blocks of every member: what two members carry in common, both are in
    none = F.array_repeat(F.lit(NO_BLOCK).cast("long"), CARRIED)
    carried = rows.groupBy("id").agg(F.slice(F.concat(F.array_sort(F.collect_set("key")), none), 1, CARRIED).alias("blocks"))
    rows = rows.withColumn("slab", F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(DENOMINATOR / NUMERATOR)) + 1e-9).cast("int"))
    salts = rows.groupBy("key", "slab").agg(F.ceil(F.count("*") / LEAF).cast("int").alias("salts"))
    salts = written(salts.where("salts > 1"), "salts")  # large slabs are few; without a shuffle by slab none of them is one task's
    salts = F.broadcast(salts) if salts.count() <= BROADCAST_KEYS // 8 else salts
    rows = rows.join(salts, ["key", "slab"], "left").withColumn("salts", F.coalesce("salts", F.lit(1))).withColumn("salt", F.pmod(F.xxhash64("id"), F.col("salts")).cast("int"))
    rows = rows.join(carried, "id").select("key", "slab", "salt", "id", "grp", "n", "point", "blocks").repartition("key", "slab", "salt").sortWithinPartitions("key", "slab", "salt")
    form = "key long, slab int, salt int, least long, high binary, ids array<long>, grps array<long>, sizes array<long>, points binary, blocks binary"
    leaves = written(rows.mapInArrow(trimmed(_leaves), form), "leaves")
    one, names = leaves.select("key", "slab", "salt", "least", "high"), ["key", "slab", "salt", "least", "high"]
    two = one.toDF(*[c if c == "key" else f"{c}2" for c in names])
    near = F.col("slab2").isin(F.col("slab"), F.col("slab") + 1, F.col("slab") + 2) & ((F.col("slab2") > F.col("slab")) | (F.col("salt2") >= F.col("salt")))
    bounds = one.join(two, "key").where(near)
    pairs = written(bounds.mapInArrow(_near_leaves, "key long, slab int, salt int, slab2 int, salt2 int"), "leaf-pairs")
    full = leaves.drop("least", "high")
    second = full.toDF(*[c if c == "key" else f"{c}2" for c in full.columns])
    return pairs.join(full, ["key", "slab", "salt"]).join(second, ["key", "slab2", "salt2"]).mapInArrow(trimmed(_joined), "a long, b long").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of each row."""
    sketches, edges = links(docs)
    labels = components(edges)
    # rows of one doc_id with different texts are one document
    same = sketches.where("rep is not null and doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    split = same.groupBy("a").count().where("count > 1").limit(1).count() or sketches.where("rep = doc_id").join(same, F.col("doc_id") == F.col("a"), "left_semi").limit(1).count()
    if split:
        labels = components(edges.unionByName(same))
        rows = sketches.join(labels.withColumnRenamed("id", "doc_id"), "doc_id", "left")
        return rows.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("label", "rep", "doc_id").alias("component_id"))
    rows = sketches.join(labels.withColumnRenamed("id", "rep"), "rep", "left")
    return rows.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("label", "rep", "doc_id").alias("component_id"))


def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))

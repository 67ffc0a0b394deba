"""Near duplicates by word shingles: a join over R-trees of count vectors.

A document is its set of shingle hashes. Hashing the shingles into groups and counting
each group makes it a point; the summed minima of two points' coordinates bound how
many shingles the two can share, and so do a point and a box of points. An R-tree over
the points therefore leaves out whole boxes, then pairs; what survives is verified on
the sets themselves. Trees have few coordinates; pairs that they admit are bounded once
more with a number of groups that grows with the sets.

One tree over a corpus is neither one task's work nor selective. The trees are built
over shards that no qualifying pair can miss: two sets as similar as asked share one of
the first shingles of either (by hash, frequent ones last), as many as either may lack
and one more, so a shard is what shares such a shingle. Points in a shard are joined first; what can still be linked is
gathered into candidate components, and only their documents' sets are compared.
Shards above a weight are cut into blocks that meet in pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.llm import arrays as A
from termloom.llm.shared import components, few, settled, whole_groups

GROUPS, LEAF, FANOUT = 32, 24, 8


def shingle_sets(texts: list[str], size: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text: A-Z lowered, words cut at ASCII white space."""
    for _, some in A.chunks(texts):
        points, starts = A.laid_out(some)
        found, ends = A.shingles(*A.words(A.ascii_lower(points), starts, A.not_ascii_space()), size)
        for a, b in zip(ends[:-1], ends[1:], strict=True):
            yield np.unique(found[a:b])


def point(shingles: np.ndarray) -> np.ndarray:
    """Counts of the shingles' groups. The number of groups, a power of two, grows with the set, as chance alone
    spreads the counts of large sets by less than two similar ones may differ in a few groups; no count exceeds a byte."""
    groups = max(GROUPS, 1 << int(len(shingles) / 12).bit_length())
    places = (shingles >> A.U(24)).astype(np.int64)
    while (counts := np.bincount(places % groups, minlength=groups)).max() > 255:
        groups *= 2
    return counts.astype(np.uint8)


def folded(points: np.ndarray, groups: int) -> np.ndarray:
    """Rows of counts with neighbouring groups added up until there are so many."""
    return points.reshape(-1, points.shape[-1] // groups, groups).sum(1, dtype=np.int32)


def bounds_of(points: list[bytes]) -> np.ndarray:
    """All points with the least number of groups: those that stand in trees."""
    out = np.zeros((len(points), GROUPS), np.int32)
    sizes = np.array([len(p) for p in points])
    for groups in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == groups)
        out[at] = folded(np.frombuffer(b"".join(points[i] for i in at), np.uint8).reshape(-1, groups), GROUPS)
    return out


def may_share(a: bytes, b: bytes, percent: int) -> bool:
    """Whether the summed minima over as many groups as both points have allow enough shared shingles."""
    groups = min(len(a), len(b))
    x, y = (folded(np.frombuffer(p, np.uint8)[None], groups)[0] for p in (a, b))
    return int(np.minimum(x, y).sum()) >= least_shared(int(x.sum()), int(y.sum()), percent)


def least_shared(a: np.ndarray | int, b: np.ndarray | int, percent: int) -> np.ndarray | int:
    """Shingles that sets of these sizes must share: 100 * shared >= percent * (a + b - shared)."""
    return -((-percent * (a + b)) // (100 + percent))


class CountTree:
    """An R-tree over count vectors, packed by sorting and tiling; points keep their given places."""

    def __init__(self, points: np.ndarray):
        self.sizes = points.sum(1)
        order = np.lexsort((*points.T[:3], self.sizes)) if len(points) <= LEAF else self._tiled(points)
        self.order = order
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # highest counts, least size, largest size of each box
        high, least, most = points[order], self.sizes[order], self.sizes[order]
        width = LEAF
        while True:
            cut = np.arange(0, len(high), width)
            high, least, most = np.maximum.reduceat(high, cut), np.minimum.reduceat(least, cut), np.maximum.reduceat(most, cut)
            self.levels.append((high, least, most))
            if len(high) == 1:
                break
            width = FANOUT
        self.points = points

    def _tiled(self, points: np.ndarray) -> np.ndarray:
        """By size in slabs, and in a slab by the groups that vary most."""
        by_size = np.argsort(self.sizes, kind="stable")
        slab = LEAF * FANOUT
        wide = np.argsort(-points.var(0), kind="stable")[:3]
        return np.concatenate([s[np.lexsort(tuple(points[s][:, g] for g in wide))] for s in (by_size[i : i + slab] for i in range(0, len(by_size), slab))])

    def leaf(self, k: int) -> np.ndarray:
        return self.order[k * LEAF : (k + 1) * LEAF]

    def leaves_near(self, high: np.ndarray, least: int, most: int, percent: int) -> np.ndarray:
        """Leaves that may hold a partner for a point in a box with these highest counts and sizes."""
        level = len(self.levels) - 1
        at = np.zeros(1, np.int64)
        while True:
            boxes, low, top = self.levels[level]
            shared = np.minimum(boxes[at], high).sum(1)
            keep = (shared >= least_shared(low[at], least, percent)) & (100 * top[at] >= percent * least) & (100 * most >= percent * low[at])
            at = at[keep]
            if level == 0 or not len(at):
                return at
            at = (at[:, None] * FANOUT + np.arange(FANOUT)).ravel()
            level -= 1
            at = at[at < len(self.levels[level][0])]


class Links:
    """Which places are connected: label is equal for those that are. The smaller side of a link is labelled anew."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.members: dict[int, list[int]] = {}
        self.found: list[tuple[int, int]] = []

    def link(self, a: int, b: int) -> None:
        self.found.append((a, b))
        x, y = int(self.label[a]), int(self.label[b])
        own, other = self.members.pop(x, [x]), self.members.pop(y, [y])
        if len(own) < len(other):
            x, own, other = y, other, own
        self.label[other] = x
        own.extend(other)
        self.members[x] = own


def join_points(points: np.ndarray, percent: int, split: int | None = None, verify=None) -> list[tuple[int, int]]:
    """Pairs of places that connect all points which can share enough, without pairs that are connected already.

    split: only pairs of a place below it with one from it on count (two blocks meet).
    verify(a, b): whether a pair that the bound admits is one; without it the bound decides.
    """
    tree, links = CountTree(points), Links(len(points))
    sizes = tree.sizes
    for k in range(len(tree.levels[0][0])):
        own = tree.leaf(k)
        high, least, most = (x[k] for x in tree.levels[0])
        for j in tree.leaves_near(high, int(least), int(most), percent).tolist():
            if j < k:
                continue
            other = tree.leaf(j)
            label = links.label
            first = label[own[0]]
            if (label[own] == first).all() and (label[other] == first).all():
                continue
            shared = np.minimum(points[own][:, None], points[other]).sum(2)
            fits = shared >= least_shared(sizes[own][:, None], sizes[other], percent)
            if j == k:
                fits &= np.tri(len(own), k=-1, dtype=bool)
            if split is not None:
                fits &= (own < split)[:, None] != (other < split)
            for i in np.flatnonzero(fits.any(1)).tolist():
                a = int(own[i])
                rest = other[fits[i]]
                while len(rest := rest[links.label[rest] != links.label[a]]):
                    b, rest = int(rest[0]), rest[1:]
                    if verify is None or verify(a, b):
                        links.link(a, b)
    return links.found


def frequent_shingles(docs: DataFrame, size: int, text_col: str, share: float = 0.001, least: int = 8, most: int = 300_000) -> np.ndarray:
    """Shingles that many documents have, sorted: at most `most` of those in `share` of a batch's documents.

    A shingle that stands in more of all documents does so in some batch. They only
    move to the end of the order in which first shingles are taken; every order finds
    all pairs, so which ones are known here changes the work and not the result.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [s for part in few([batch]) for s in shingle_sets([t or "" for t in part.column(0).to_pylist()], size)]
            found, times = np.unique(np.concatenate(own), return_counts=True) if own else (np.zeros(0, A.U), np.zeros(0, np.int64))
            often = times >= max(least, share * len(own))
            yield pa.RecordBatch.from_arrays([pa.array(found[often].astype(np.int64)), pa.array(times[often].astype(np.int64))], ["key", "n"])

    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    return np.sort(np.array([r["key"] for r in counted.orderBy(F.desc("n"), "key").limit(most).collect()], np.int64).view(A.U))


def _features(docs: DataFrame, frequent: np.ndarray, size: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, n, print (of the whole set), point, firsts: the first shingles, one more than a partner may lack; frequent ones come last."""
    sent = docs.sparkSession.sparkContext.broadcast(frequent)  # of bounded number

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        late = sent.value
        for batch in few(batches):
            n, prints, points, firsts = [], [], [], []
            for s in shingle_sets([t or "" for t in batch.column(1).to_pylist()], size):
                n.append(len(s))
                prints.append(np.array([s.sum(dtype=A.U), A.mixed(s).sum(dtype=A.U) if len(s) else A.U(0)], "<u8").tobytes())
                points.append(point(s).tobytes() if len(s) else b"")
                often = late[np.minimum(np.searchsorted(late, s), len(late) - 1)] == s if len(late) else np.zeros(len(s), bool)
                ordered = np.concatenate([s[~often], s[often]])
                firsts.append(ordered[: len(s) - (percent * len(s) + 99) // 100 + 1].view(np.int64) if len(s) else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(prints, pa.binary()), pa.array(points, pa.binary()), pa.array(firsts, pa.list_(pa.int64()))],
                ["doc_id", "n", "print", "point", "firsts"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        read, "doc_id long, n long, print binary, point binary, firsts array<long>")


def rows_of(rows: DataFrame, ids: DataFrame, bits: int = 25) -> DataFrame:
    """rows whose doc_id may be in ids: a filter of 2**bits bits, so at most 2**(bits - 6) numbers, before a join that decides."""
    place = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(11)), 64 - bits)
    word, bit = F.shiftright(place, 6), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(64)).cast("int"))
    words = settled(ids.select(word.alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("set")), "id-filter")
    return rows.withColumn("word", word).join(F.broadcast(words), "word").where(F.col("set").bitwiseAND(bit) != 0).drop("word", "set")


def in_blocks(members: DataFrame, unit: Column, weight: str, most: int) -> DataFrame:
    """members (doc_id, ...) with `unit`, and where they meet: first, second, of two blocks of their unit.

    A unit's weight is summed with a partial count; one of more than `most` is cut into
    as many blocks as needed by a hash, and each row goes to every pair its block is in.
    """
    rows = members.withColumn("unit", unit)
    heavy = rows.groupBy("unit").agg(F.ceil(F.sum(weight) / most).cast("int").alias("blocks")).where("blocks > 1")
    cut = rows.join(heavy, "unit", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.col("blocks")).cast("int")
    return cut.withColumn("block", own).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        *rows.columns, F.least("block", "with").alias("first"), F.greatest("block", "with").alias("second"), "block")


def _groups(df: DataFrame) -> DataFrame:
    return df.repartition("unit", "first", "second").sortWithinPartitions("unit", "first", "second", "block", "doc_id")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", most_points: int = 100_000, most_shingles: int = 8_000_000) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id.

    Two documents link when 100 * shared >= percent * united distinct shingles of `size`
    words; a text with fewer words is one shingle; component_id is the smallest id
    reachable by links. A null, empty or white text has no shingles, is linked with
    nothing and is its own component. Rows of one id stand for one document: if their
    texts differ, each may link it. A null id is returned as it is and links nothing. No partner is
    left out, however long the text or large the group. An empty table gives no rows.

    most_points and most_shingles bound what one task holds of a shard; a shard above
    them is cut into blocks.
    """
    frequent = frequent_shingles(docs, size, text_col)
    features = settled(_features(docs, frequent, size, percent, id_col, text_col), "shingle-points")
    filled = features.where("n > 0 AND doc_id IS NOT NULL")
    classes = filled.groupBy("print", "n").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
    reps = settled(
        filled.select("doc_id", "print", "n").join(classes.where("copies > 1"), ["print", "n"], "left")
        .select("doc_id", "print", "n", F.coalesce("rep", "doc_id").alias("rep")), "shingle-classes")
    # of equal sets one goes on; an id's other sets stay
    standing = filled.join(reps.where("doc_id <> rep").select("doc_id", "print", "n").distinct(), ["doc_id", "print", "n"], "left_anti").select("doc_id", "n", "point", "firsts")

    keys = standing.select("doc_id", F.explode("firsts").alias("key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("times")).where("times > 1").select("key")
    held = settled(keys.join(shared, "key", "left_semi").select("doc_id", "key"), "shard-keys")
    # copies share many keys: of those with the same documents, told by count, ends and a sum of hashes, one is a shard
    same = held.groupBy("key").agg(F.count("*").alias("times"), F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.sum(F.xxhash64("doc_id").cast("decimal(20,0)")).alias("all"))
    chosen = same.groupBy("times", "least", "most", "all").agg(F.min("key").alias("key")).select("key")
    held = settled(held.join(chosen, "key", "left_semi"), "shards")
    points = standing.select("doc_id", "point").join(held.select("doc_id").distinct(), "doc_id", "left_semi")
    sharded = in_blocks(held.join(points, "doc_id").withColumn("one", F.lit(1)), F.col("key"), "one", most_points)

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, bounds in whole_groups(batches, ["unit", "first", "second"]):
            ids = rows.column("doc_id").to_numpy()
            full = rows.column("point").to_pylist()
            at = bounds_of(full)
            sizes, starts = np.diff(bounds), bounds[:-1]
            two = starts[sizes == 2]  # most shards; one pair each
            one_block = rows.column("first").to_numpy() == rows.column("second").to_numpy()
            two = two[one_block[two]]
            total = at.sum(1)
            fit = np.minimum(at[two], at[two + 1]).sum(1) >= least_shared(total[two], total[two + 1], percent)
            two = np.array([i for i in two[fit].tolist() if may_share(full[i], full[i + 1], percent)], np.int64)
            a, b = [two], [two + 1]
            for k in np.flatnonzero((sizes > 2) | ((sizes == 2) & ~one_block[starts])).tolist():
                begin, end = bounds[k], bounds[k + 1]

                def finer(x: int, y: int, begin=begin, full=full) -> bool:
                    return may_share(full[begin + x], full[begin + y], percent)

                pairs = np.array(join_points(at[begin:end], percent, _split(rows.slice(begin, end - begin)), finer), np.int64).reshape(-1, 2)
                a.append(pairs[:, 0] + begin), b.append(pairs[:, 1] + begin)
            left, right = ids[np.concatenate(a)], ids[np.concatenate(b)]
            pairs = np.unique(np.stack([np.minimum(left, right), np.maximum(left, right)], 1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0], pa.int64()), pa.array(pairs[:, 1], pa.int64())], ["a", "b"])

    maybe = components(_groups(sharded.select("unit", "first", "second", "block", "doc_id", "point")).mapInArrow(bound, "a long, b long"), "maybe")
    candidates = settled(maybe.join(standing.select(F.col("doc_id").alias("id"), "n"), "id").select(F.col("id").alias("doc_id"), "component", "n"), "candidates")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("text IS NOT NULL")
    gathered = in_blocks(candidates, F.col("component"), "n", most_shingles).select("unit", "first", "second", "block", "doc_id")

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, bounds in whole_groups(batches, ["unit", "first", "second"]):
            left, right = [], []
            for begin, end in zip(bounds[:-1], bounds[1:], strict=True):
                group = rows.slice(begin, end - begin)
                ids = group.column("doc_id").to_numpy()
                sets = list(shingle_sets([t or "" for t in group.column("text").to_pylist()], size))

                def verify(a: int, b: int, sets=sets) -> bool:
                    x, y = sorted((sets[a], sets[b]), key=len)
                    there = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum()) if len(x) else 0
                    return there > 0 and 100 * there >= percent * (len(x) + len(y) - there)

                at = bounds_of([point(s).tobytes() if len(s) else bytes(GROUPS) for s in sets])
                for a, b in join_points(at, percent, _split(group), verify) if len(ids) > 1 else ():
                    left.append(int(ids[a])), right.append(int(ids[b]))
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    links = _groups(gathered.join(rows_of(texts, candidates.select("doc_id")), "doc_id")).mapInArrow(exact, "a long, b long")
    linked = components(links.unionByName(reps.where("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))), "near")
    return features.select("doc_id", "n").join(linked, features["doc_id"] == linked["id"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def _split(group: pa.Table) -> int | None:
    """Where the second block begins, if the group is of two blocks."""
    if group.column("first")[0] == group.column("second")[0]:
        return None
    block = group.column("block").to_numpy()
    return int((block == block[0]).sum()) if block[0] != block[-1] else len(block)

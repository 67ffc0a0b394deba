"""Benchmark items inside documents: MinHash search over windows fitted to the items' sizes.

A short item has next to no resemblance to a long document as a whole. Items are
therefore parted by their number of shingles, and every document is read in windows of
twice a part's largest size, each overlapping the next by half: an item's passage lies
whole in some window and makes up a good part of it. A window and an item that agree in
a minimum of any of the hash functions are a candidate; the share of the item's
shingles that the whole document has decides.

Few shingles make few minima, so items of up to eight are not left to chance: the hashes
of their shingles are looked up one by one. An item with fewer words than a shingle is
one shingle of its own length, and is looked for among the documents' runs of as many words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm import arrays as A
from termloom.llm.shared import few

FUNCTIONS, BLOCK = 64, 16
#: Items of up to so many shingles are found by every one of them.
FEW = 8


def shingle_sets(texts: list[str], size: int) -> list[np.ndarray]:
    """Sorted distinct shingles of each text: `size` lowered words of letters and digits."""
    out = []
    for _, some in A.chunks([t.lower() for t in texts]):
        hashes, bounds = A.words(*A.laid_out(some), A.letters_and_digits())
        found, ends = A.shingles(hashes, bounds, size)
        out += [np.unique(found[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
    return out


def word_counts(texts: list[str]) -> list[int]:
    out: list[int] = []
    for _, some in A.chunks([t.lower() for t in texts]):
        out += np.diff(A.words(*A.laid_out(some), A.letters_and_digits())[1]).tolist()
    return out


class Lookup:
    """Items by the hashes of their shingles, asked for all shingles of many texts at once."""

    def __init__(self, rows: list[tuple[np.uint64, int]]):
        order = sorted(rows)
        self.hashes, self.items = np.array([h for h, _ in order], A.U), [i for _, i in order]
        self.marks = np.zeros(1 << 16, bool)
        self.marks[(self.hashes >> A.U(48)).astype(np.int64)] = True

    def found(self, shingles: np.ndarray, bounds: np.ndarray) -> set[tuple[int, int]]:
        """(text, item) for every text that has one of the item's shingles."""
        near = np.flatnonzero(self.marks[(shingles >> A.U(48)).astype(np.int64)]) if self.items else []
        if not len(near):
            return set()
        a, b = np.searchsorted(self.hashes, shingles[near], "left"), np.searchsorted(self.hashes, shingles[near], "right")
        docs = np.searchsorted(bounds, near[b > a], "right") - 1
        return {(doc, item) for doc, x, y in zip(docs.tolist(), a[b > a].tolist(), b[b > a].tolist(), strict=True) for item in self.items[x:y]}


def functions() -> tuple[np.ndarray, np.ndarray]:
    seeds = A.mixed(np.arange(1, 2 * FUNCTIONS + 1, dtype=A.U))
    return seeds[:FUNCTIONS] | A.U(1), seeds[FUNCTIONS:]


class Items:
    """A block of items, ready to be looked for: for each size part and hash function the sorted minima."""

    def __init__(self, ids: list[int], texts: list[str], size: int):
        self.size = size
        sets = shingle_sets(texts, size)
        words = [n for n, s in zip(word_counts(texts), sets, strict=True) if len(s)]
        self.ids = [i for i, s in zip(ids, sets, strict=True) if len(s)]
        self.sets = [s for s in sets if len(s)]
        self.by_length = {
            n: Lookup([(s[0], i) for i, s in enumerate(self.sets) if words[i] == n]) for n in range(1, size) if n in words}
        whole = [i for i, n in enumerate(words) if n >= size]
        self.few = Lookup([(h, i) for i in whole if len(self.sets[i]) <= FEW for h in self.sets[i]])
        of = {i: max(0, int(np.ceil(np.log2(len(self.sets[i]) / BLOCK)))) for i in whole if len(self.sets[i]) > FEW}
        blocks = [of.get(i, -1) for i in range(len(self.sets))]  # part k: up to BLOCK * 2**k shingles
        self.parts = {k: np.flatnonzero(np.array(blocks) == k) for k in sorted(set(of.values()))}
        multiply, add = functions()
        minima = np.zeros((len(self.sets), FUNCTIONS), A.U)
        for i in of:
            minima[i] = [((self.sets[i] * m) ^ a).min() for m, a in zip(multiply, add, strict=True)]
        self.tables, self.marks = {}, {}
        for k, of in self.parts.items():
            for f in range(FUNCTIONS):
                order = np.argsort(minima[of, f], kind="stable")
                self.tables[k, f] = minima[of, f][order], of[order]
                marks = np.zeros(1 << 16, bool)
                marks[(minima[of, f] >> A.U(48)).astype(np.int64)] = True
                self.marks[k, f] = marks

    def candidates(self, found: np.ndarray, bounds: np.ndarray) -> set[tuple[int, int]]:
        """(text, item) where some window and the item share a minimum; found: shingles of all texts, in order."""
        out = self.few.found(found, bounds)
        counts = np.diff(bounds)
        per = -(-counts // BLOCK)
        if not per.sum() or not self.parts:
            return out
        first = np.concatenate([[0], np.cumsum(per)])
        doc = np.repeat(np.arange(len(counts)), per)
        starts = bounds[doc] + BLOCK * (np.arange(first[-1]) - first[doc])
        multiply, add = functions()
        last = first[doc + 1] - 1
        for f in range(FUNCTIONS):
            low = np.minimum.reduceat((found * multiply[f]) ^ add[f], starts)  # of each block
            at, width = np.arange(len(low)), 1
            for k in range(max(self.parts) + 1):
                # low: minimum over 2**k blocks from each block on, within the text
                window = np.minimum(low, low[np.minimum(at + width, last)])
                if k in self.parts:
                    # every 2**k-th block of a text begins a window of twice that many
                    use = at[(at - first[doc]) % width == 0] if width > 1 else at
                    near = use[self.marks[k, f][(window[use] >> A.U(48)).astype(np.int64)]]
                    values, items = self.tables[k, f]
                    a, b = np.searchsorted(values, window[near], "left"), np.searchsorted(values, window[near], "right")
                    for i, x, y in zip(near[b > a].tolist(), a[b > a].tolist(), b[b > a].tolist(), strict=True):
                        out.update((int(doc[i]), int(j)) for j in items[x:y])
                low, width = window, width * 2
        return out

    def search(self, texts: list[str], share: float) -> list[tuple[int, int, float]]:
        """(text, item id, containment) of all items that have at least `share` of their shingles in the text."""
        out = []
        for at, some in A.chunks([t.lower() for t in texts]):
            hashes, bounds = A.words(*A.laid_out(some), A.letters_and_digits())
            found, ends = A.shingles(hashes, bounds, self.size)
            own: dict[int, np.ndarray] = {}
            for n, lookup in self.by_length.items():
                out += [(at + doc, self.ids[item], 1.0) for doc, item in sorted(lookup.found(*A.shingles(hashes, bounds, n)))]
            for doc, item in sorted(self.candidates(found, ends)):
                if doc not in own:
                    own = {doc: np.unique(found[ends[doc] : ends[doc + 1]])}
                there = own[doc][np.minimum(np.searchsorted(own[doc], self.sets[item]), len(own[doc]) - 1)] == self.sets[item]
                if there.sum() >= share * len(there) - 1e-9:
                    out.append((at + doc, self.ids[item], float(there.mean())))
        return out


def find_items(docs: DataFrame, items: DataFrame, share: float = 0.8, size: int = 5, block_items: int = 5000, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, containment): which items have at least `share` of their distinct shingles in which documents.

    Shingles are `size` lowered words of letters and digits. A shorter item is found
    where its words stand one after the other; one without words is never found.
    Documents are read whole.
    Items go to the tasks in blocks of block_items, one pass over the documents each,
    so no broadcast grows with the benchmark. Null texts count as empty, items with a
    null id keep it, repeated rows are searched each, equal items are all found. An
    empty table on either side gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    kind = docs.select(id_col).schema[0].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    listed = items.select(F.col(item_col).cast("long").alias("item_id"), F.coalesce(F.col(item_text_col), F.lit("")).alias("text"))
    schema = f"doc_id {kind}, item_id long, containment double"
    out = spark.createDataFrame([], schema)
    blocks = max(1, -(-listed.count() // block_items))
    for block in range(blocks):
        some = listed.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        if not some:
            continue
        sent = spark.sparkContext.broadcast(([r["item_id"] for r in some], [r["text"] for r in some]))

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            own = Items(*sent.value, size)
            for batch in few(batches):
                found = own.search([t or "" for t in batch.column(1).to_pylist()], share) if own.sets else []
                place = pa.array([f[0] for f in found], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(place), pa.array([f[1] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.float64())], ["doc_id", "item_id", "containment"])

        out = out.unionByName(rows.mapInArrow(search, schema))
    return out

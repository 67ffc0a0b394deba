"""Token sequences of fixed length, packed by minimum bin slack.

Texts are tokenised once. What decides the packing is how many pieces there are of
each length, a table of at most `size` rows whatever the corpus; the plan made from it
is as small, and every piece finds its place from its length and its rank alone.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termloom.llm.shared import few, settled

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"


@lru_cache(2)
def encoder(path: str):
    """text -> ids of the tokenizer file at path.

    Where the same vocabulary lies beside it as ranks, the faster library reads that;
    a text that it cannot take, or that holds the string of an added token, is left to
    the tokenizer itself, with its own settings.
    """
    import json
    import os

    from tokenizers import Tokenizer

    made: list[Tokenizer] = []  # only where it is needed: it takes ten times the memory of the ranks

    def slow(text: str) -> list[int]:
        if not made:
            made.append(Tokenizer.from_file(path))
        return made[0].encode(text, add_special_tokens=False).ids

    ranks = path.removesuffix(".json") + ".tiktoken"
    if not (path.endswith(".json") and os.path.exists(ranks)):
        return slow
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as file:
        added = [token["content"] for token in json.load(file).get("added_tokens", [])]
    with open(ranks, "rb") as lines:
        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    def ids(text: str) -> list[int]:
        if any(token in text for token in added):
            return slow(text)
        try:
            return fast.encode_ordinary(text)
        except BaseException as e:  # the library's panics are no Exception
            if isinstance(e, (KeyboardInterrupt, SystemExit, GeneratorExit, MemoryError)):
                raise
            return slow(text)

    return ids


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; the first takes what does not fill a piece."""
    if n <= size:
        return [(0, n)]
    head = n % size
    return [(0, head)] * (head > 0) + [(at, size) for at in range(head, n, size)]


def tokenised(docs: DataFrame, path: str, size: int, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All pieces with the crc32 of their ids; nth counts the pieces of equal length in a task."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of, part, seen = encoder(path), TaskContext.get().partitionId(), np.zeros(size + 1, np.int64)
        for batch in few(batches):
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.array([*ids_of(text or ""), end_id], "<u4")
                for k, (at, n) in enumerate(cut(len(ids), size)):
                    rows.append((doc_id, k, at, n, zlib.crc32(ids[at : at + n].tobytes()), part, int(seen[n])))
                    seen[n] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 7, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()), strict=True)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(pieces, PIECES)


def fullest(counts: np.ndarray, size: int, first: int) -> list[int]:
    """Lengths, `first` among them, that fill a bin as far as any combination of what is left can.

    Bit s of a number says that sum s can be reached. Each length enters as copies of
    one, two, four ... of it; walking back over the numbers gives the combination.
    """
    room = size - first
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    left = counts.copy()
    left[first] -= 1
    for length in np.flatnonzero(left[: room + 1])[::-1].tolist():
        most, copies = min(int(left[length]), room // length), 1
        while most > 0:
            copies = min(copies, most)
            steps.append((reach, length, copies))
            reach |= (reach << (length * copies)) & mask
            most -= copies
            copies *= 2
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, [first]
    for before, length, copies in reversed(steps):
        if not before >> total & 1:
            chosen += [length] * copies
            total -= length * copies
    return chosen


def bin_plan(counts: dict[int, int], size: int) -> list[tuple[int, list[int]]]:
    """(bins, lengths in each) until no piece is left: minimum bin slack, equal bins taken together.

    A combination is repeated as often as what is left allows; every step uses up a
    length, so there are at most `size` steps.
    """
    left = np.zeros(size + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    plan = []
    while left.any():
        chosen = fullest(left, size, int(np.flatnonzero(left)[-1]))
        lengths, times = np.unique(chosen, return_counts=True)
        repeats = int((left[lengths] // times).min())
        left[lengths] -= times * repeats
        plan.append((repeats, chosen))
    return plan


def places(plan: list[tuple[int, list[int]]], size: int) -> dict[int, np.ndarray]:
    """For each length the rows (first rank, bins, first sequence, offset): rank r lies in sequence first + (r - rank)."""
    out: dict[int, list[tuple[int, int, int, int]]] = {}
    used = np.zeros(size + 1, np.int64)
    sequence = 0
    for repeats, chosen in plan:
        offset = 0
        for length in chosen:
            out.setdefault(length, []).append((int(used[length]), repeats, sequence, offset))
            used[length] += repeats
            offset += length
        sequence += repeats
    return {length: np.array(rows, np.int64) for length, rows in out.items()}


def pack(docs: DataFrame, path: str, size: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row per piece.

    A document is its ids and end_id after them; null text counts as empty and is one
    token long. Only documents longer than `size` are cut. Repeated rows are packed
    each on its own; rows with a null id, too. An empty table gives no rows. Very long
    texts give many pieces, which fill sequences of their own. Ids are whole numbers, or
    texts that spell one; others raise.
    """
    pieces = settled(tokenised(docs, path, size, end_id, id_col, text_col), "pieces")
    by_part = settled(pieces.groupBy("length", "part").agg(F.count("*").alias("n")), "piece-counts")
    counts = {int(r[0]): int(r[1]) for r in by_part.groupBy("length").agg(F.sum("n")).collect()}  # at most `size` rows
    table = places(bin_plan(counts, size), size)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = by_part.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    ranked = pieces.join(firsts, ["length", "part"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("nth")).alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for n in np.unique(length).tolist():
                rows, at = table[n], np.flatnonzero(length == n)
                use = rows[np.searchsorted(rows[:, 0], rank[at], "right") - 1]
                sequence[at], offset[at] = use[:, 2] + rank[at] - use[:, 0], use[:, 3]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(sequence), pa.array(offset)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")

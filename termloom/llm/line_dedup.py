"""Reversible line dedup: exact reference counts of lines, with sharded cuckoo filters before them.

A line's key is the line without ASCII white space at its ends, with A-Z lowered. The
reference table counts the documents of each key; all rows of one id are one document. The keys
of at least `min_docs` documents are held in cuckoo filters, one per shard of the key's digest; documents can
be added and taken away again, and the filters follow. What a filter holds wrongly is
found by asking it for every other key of the reference table, so its answers are exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termloom.llm.shared import BROADCAST_BYTES, few, settled

SPACES = b" \t\n\x0b\x0c\r"
SLOTS, MOVES = 4, 500


def line_keys(text: str | None) -> list[bytes]:
    return [line.strip(SPACES) for line in (text or "").encode("utf-8", "surrogatepass").lower().split(b"\n")]


def digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def halves(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)


class CuckooFilter:
    """Buckets of four 32-bit fingerprints; a key can stand in two buckets, and be removed again.

    One key is entered once at most. `add` says False when there is no room.
    """

    def __init__(self, table: np.ndarray):
        self.table = table

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        return cls(np.zeros((1 << max(2, int(keys / SLOTS / 0.8)).bit_length(), SLOTS), np.uint32))

    @classmethod
    def loads(cls, data: bytes) -> CuckooFilter:
        return cls(np.frombuffer(data, np.uint32).reshape(-1, SLOTS).copy())

    def dumps(self) -> bytes:
        return self.table.tobytes()

    def _ends(self, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mask = np.uint64(len(self.table) - 1)
        prints = np.maximum(pair[:, 1] & np.uint64(0xFFFFFFFF), np.uint64(1))
        one = (pair[:, 1] >> np.uint64(32)) & mask
        return prints.astype(np.uint32), one, one ^ self._step(prints)

    def _step(self, prints: np.ndarray) -> np.ndarray:
        return ((prints * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)) & np.uint64(len(self.table) - 1)

    def holds(self, pair: np.ndarray) -> np.ndarray:
        prints, one, two = self._ends(pair)
        return ((self.table[one] == prints[:, None]) | (self.table[two] == prints[:, None])).any(1)

    def add(self, pair: np.ndarray) -> bool:
        prints, ones, twos = self._ends(pair)
        for p, one, two in zip(prints.tolist(), ones.tolist(), twos.tolist(), strict=True):
            if not (self._put(one, p) or self._put(two, p) or self._move(two, p)):
                return False
        return True

    def _put(self, bucket: int, p: int) -> bool:
        free = np.flatnonzero(self.table[bucket] == 0)
        if len(free):
            self.table[bucket, free[0]] = p
        return len(free) > 0

    def _move(self, bucket: int, p: int) -> bool:
        for k in range(MOVES):
            slot = (p + k) % SLOTS
            p, self.table[bucket, slot] = int(self.table[bucket, slot]), p
            bucket ^= int(self._step(np.array([p], np.uint64))[0])
            if self._put(bucket, p):
                return True
        return False

    def remove(self, pair: np.ndarray) -> None:
        prints, ones, twos = self._ends(pair)
        for p, one, two in zip(prints.tolist(), ones.tolist(), twos.tolist(), strict=True):
            for bucket in (one, two):
                at = np.flatnonzero(self.table[bucket] == p)
                if len(at):
                    self.table[bucket, at[0]] = 0
                    break


def references(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(digest, refs): in how many documents each line key stands; counted in every batch, then in every task, before the shuffle.

    All rows of one id are one document, a row without an id is one of its own. Only rows
    whose id is repeated send their keys with the id, and each is counted once.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[bytes, int] = {}
            for part in few([batch]):
                for text in part.column(0).to_pylist():
                    for key in set(line_keys(text)):
                        if key:
                            found[key] = found.get(key, 0) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([digest(k) for k in found], pa.binary()), pa.array(list(found.values()), pa.int64())], ["digest", "refs"])

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few(batches):
            keys = [{k for k in line_keys(t) if k} for t in batch.column(1).to_pylist()]
            of = batch.column(0).take(pa.array(np.repeat(np.arange(len(keys)), [len(k) for k in keys])))
            yield pa.RecordBatch.from_arrays([of, pa.array([digest(k) for own in keys for k in own], pa.binary())], ["doc_id", "digest"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    again = rows.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    again = settled(again, "line-repeated-ids")
    known = T.StructType([rows.schema["doc_id"], T.StructField("digest", T.BinaryType())])
    if again.isEmpty():
        return rows.select("text").mapInArrow(count, "digest binary, refs long").groupBy("digest").agg(F.sum("refs").alias("refs"))
    single = rows.join(again, "doc_id", "left_anti").select("text").mapInArrow(count, "digest binary, refs long")
    repeated = rows.join(again, "doc_id", "left_semi").mapInArrow(named, known).distinct().select("digest", F.lit(1).cast("long").alias("refs"))
    return single.unionByName(repeated).groupBy("digest").agg(F.sum("refs").alias("refs"))


def inventory(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, alone, n, print): the documents as they are told apart; alone is the text's hash where there is no id."""
    mark = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.when(F.col(id_col).isNull(), mark).alias("alone"), mark.alias("mark"))
    return rows.groupBy("doc_id", "alone").agg(F.count("*").alias("n"), F.sum(F.col("mark").cast("decimal(38,0)")).alias("print"))


@dataclass
class LineIndex:
    """refs (shard, digest, refs) and filters (shard, data): the state after some inserts and deletes; documents: what is in it."""

    refs: DataFrame
    filters: DataFrame
    documents: DataFrame
    shards: int
    min_docs: int

    @classmethod
    def of(cls, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10, shards: int = 64) -> LineIndex:
        """The index of a table; the list of its documents is made when the first change asks for it."""
        refs = settled(_sharded(references(docs, id_col, text_col), shards), "line-refs")
        return cls(refs, settled(_built(refs.where(F.col("refs") >= min_docs)), "line-filters"), inventory(docs, id_col, text_col), shards, min_docs)

    def insert(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> LineIndex:
        """Adds documents. An id that is in the index already raises ValueError, and nothing changes."""
        return self._changed(docs, id_col, text_col, 1)

    def delete(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> LineIndex:
        """Takes documents away that were inserted before; counts that reach nought leave the table.

        A document that is not in the index, or not with these rows, raises ValueError and
        nothing changes: taking it away would leave counts that no insert can mend.
        """
        return self._changed(docs, id_col, text_col, -1)

    def _documents(self, docs: DataFrame, id_col: str, text_col: str, sign: int) -> DataFrame:
        """The documents after a change; ValueError if they do not allow it."""
        known, change = settled(self.documents, "line-documents"), settled(inventory(docs, id_col, text_col), "line-change")
        same = known["doc_id"].eqNullSafe(change["doc_id"]) & known["alone"].eqNullSafe(change["alone"])
        both = known.join(change, same, "full").select(
            F.coalesce(known["doc_id"], change["doc_id"]).alias("doc_id"), F.coalesce(known["alone"], change["alone"]).alias("alone"),
            *(F.coalesce(side[c], F.lit(0)).alias(f"{name}_{c}") for name, side in (("was", known), ("more", change)) for c in ("n", "print")))
        touched = F.col("more_n") > 0
        if sign > 0:
            wrong = F.col("doc_id").isNotNull() & (F.col("was_n") > 0)
        else:
            whole = (F.col("was_n") == F.col("more_n")) & (F.col("was_print") == F.col("more_print"))
            wrong = F.when(F.col("doc_id").isNull(), F.col("was_n") < F.col("more_n")).otherwise(~whole)
        after = settled(both.select("*", (touched & wrong).alias("wrong")), "line-documents")
        refused = after.where("wrong").count()
        if refused:
            raise ValueError(f"{refused} documents are {'in the index already' if sign > 0 else 'not in the index with these rows'}")
        n, mark = F.col("was_n") + sign * F.col("more_n"), F.col("was_print") + sign * F.col("more_print")
        return after.select("doc_id", "alone", n.alias("n"), mark.cast("decimal(38,0)").alias("print")).where("n > 0")

    def _changed(self, docs: DataFrame, id_col: str, text_col: str, sign: int) -> LineIndex:
        documents = self._documents(docs, id_col, text_col, sign)
        change = _sharded(references(docs, id_col, text_col), self.shards).select("shard", "digest", (F.col("refs") * sign).alias("more"))
        both = self.refs.select("shard", "digest", F.col("refs").alias("was"), F.lit(0).cast("long").alias("more")).unionByName(
            change.withColumn("was", F.lit(0).cast("long")).select("shard", "digest", "was", "more"))
        after = settled(both.groupBy("shard", "digest").agg(F.sum("was").alias("was"), (F.sum("was") + F.sum("more")).alias("refs")), "line-refs")
        least = self.min_docs
        crossed = after.where((F.col("was") >= least) != (F.col("refs") >= least)).select("shard", "digest", (F.col("refs") >= least).alias("joins"))

        def follow(old: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
            shard = int((old if len(old) else keys)["shard"].iloc[0])
            new = CuckooFilter.loads(old["data"].iloc[0]) if len(old) else CuckooFilter.sized(len(keys))
            gone, come = keys[~keys["joins"].astype(bool)], keys[keys["joins"].astype(bool)]
            new.remove(halves(list(gone["digest"])))
            room = new.add(halves(list(come["digest"])))
            return pd.DataFrame({"shard": [shard], "data": [new.dumps() if room else None]})

        filters = settled(self.filters.groupBy("shard").cogroup(crossed.groupBy("shard")).applyInPandas(follow, "shard int, data binary"), "line-filters")
        refs = after.where("refs > 0").select("shard", "digest", "refs")
        full = filters.where("data IS NULL").select("shard")  # no more rows than shards
        rebuilt = _built(refs.where(F.col("refs") >= least).join(F.broadcast(full), "shard", "left_semi"))
        return LineIndex(refs, filters.where("data IS NOT NULL").unionByName(rebuilt), documents, self.shards, least)

    def frequent(self) -> DataFrame:
        return self.refs.where(F.col("refs") >= self.min_docs).select("digest")

    def drop_lines(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
        """docs as (doc_id, n_lines, n_dropped, kept_text): the lines that no frequent key has, in their order.

        Filters of up to `broadcast_bytes` go to every task with the few keys that they
        hold wrongly; larger ones stay, and the line digests are joined with the
        reference table instead. Both ways give the same rows.
        """
        small = self.filters.agg(F.coalesce(F.sum(F.length("data")), F.lit(0))).first()[0] <= broadcast_bytes
        rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        return self._filtered(rows) if small else self._joined(rows)

    def rewrite(self, docs: DataFrame, text_col: str = "text", length_col: str = "n_chars", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
        """docs, all columns, with the text that drop_lines keeps and, where there is such a column, its length; null texts stay null."""
        rest = F.struct(*(F.col(c) for c in docs.columns if c != text_col), F.col(text_col).isNull().alias("_absent"))
        kept = self.drop_lines(docs.select(rest.alias("doc_id"), text_col), "doc_id", text_col, broadcast_bytes)
        text = F.when(~F.col("doc_id._absent"), F.col("kept_text"))
        made = {text_col: text, length_col: F.char_length(text).cast(docs.schema[length_col].dataType) if length_col in docs.columns else None}
        return kept.select(*(made[c].alias(c) if c in made else F.col("doc_id").getField(c).alias(c) for c in docs.columns))

    def _filtered(self, rows: DataFrame) -> DataFrame:
        spark = rows.sparkSession
        data = {int(r["shard"]): bytes(r["data"]) for r in self.filters.collect()}
        parts, shards = spark.sparkContext.broadcast(data), self.shards

        def asked(pairs: np.ndarray, filters: dict[int, CuckooFilter]) -> np.ndarray:
            out, of = np.zeros(len(pairs), bool), (pairs[:, 0] % np.uint64(shards)).astype(int)
            for shard in np.unique(of).tolist():
                if shard in filters:
                    at = np.flatnonzero(of == shard)
                    out[at] = filters[shard].holds(pairs[at])
            return out

        def wrong(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            filters = {k: CuckooFilter.loads(v) for k, v in parts.value.items()}
            for batch in batches:
                digests = batch.column(0)
                keep = asked(halves(digests.to_pylist()), filters)
                yield pa.RecordBatch.from_arrays([digests.filter(pa.array(keep))], ["digest"])

        # of other keys, about one in half a thousand million meets a fingerprint
        others = self.refs.where(F.col("refs") < self.min_docs).select("digest").mapInArrow(wrong, "digest binary")
        never = settled(others, "line-filter-errors")
        if never.count() * 16 > BROADCAST_BYTES:
            return self._joined(rows)
        errors = spark.sparkContext.broadcast({bytes(r[0]) for r in never.collect()})

        def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            filters = {k: CuckooFilter.loads(v) for k, v in parts.value.items()}
            for batch in few(batches):
                texts = batch.column(1).to_pylist()
                keys = [line_keys(t) for t in texts]
                digests = [digest(k) for ks in keys for k in ks]
                hit = asked(halves(digests), filters) if digests else np.zeros(0, bool)
                if errors.value:
                    for i in np.flatnonzero(hit).tolist():
                        hit[i] = digests[i] not in errors.value
                yield _result(batch.column(0), texts, keys, hit)

        return rows.mapInArrow(drop, _schema(rows))

    def _joined(self, rows: DataFrame) -> DataFrame:
        """What to drop depends on the text alone, so its places travel by a digest of the text.

        Of the lines only digests are shuffled; texts are, once, to meet their places.
        """

        def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in few(batches):
                of, at, digests = [], [], []
                for text in set(batch.column(0).to_pylist()):
                    name = digest(text.encode("utf-8", "surrogatepass"))
                    for i, key in enumerate(line_keys(text)):
                        of.append(name), at.append(i), digests.append(digest(key))
                yield pa.RecordBatch.from_arrays([pa.array(of, pa.binary()), pa.array(at, pa.int32()), pa.array(digests, pa.binary())], ["of", "at", "digest"])

        def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in few(batches):
                names = [digest(t.encode("utf-8", "surrogatepass")) for t in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names, pa.binary())], ["doc_id", "text", "of"])

        def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in few(batches):
                texts = batch.column(1).to_pylist()
                keys = [line_keys(t) for t in texts]
                gone = [set(g or ()) for g in batch.column(2).to_pylist()]
                hit = np.array([i in g for ks, g in zip(keys, gone, strict=True) for i in range(len(ks))], bool)
                yield _result(batch.column(0), texts, keys, hit)

        lines = rows.select("text").mapInArrow(spread, "of binary, at int, digest binary")
        places = lines.join(self.frequent(), "digest", "left_semi").groupBy("of").agg(F.collect_set("at").alias("gone"))
        key = T.StructType([rows.schema["doc_id"], T.StructField("text", T.StringType()), T.StructField("of", T.BinaryType())])
        return rows.mapInArrow(named, key).join(places, "of", "left").select("doc_id", "text", "gone").mapInArrow(drop, _schema(rows))


def _schema(rows: DataFrame) -> T.StructType:
    counts = [T.StructField(c, T.LongType()) for c in ("n_lines", "n_dropped")]
    return T.StructType([rows.schema["doc_id"], *counts, T.StructField("kept_text", T.StringType())])


def _result(ids: pa.Array, texts: list[str], keys: list[list[bytes]], hit: np.ndarray) -> pa.RecordBatch:
    """hit: one flag per line of all texts; lines with an empty key always stay."""
    kept, dropped, at = [], [], 0
    for text, own in zip(texts, keys, strict=True):
        flags = hit[at : at + len(own)]
        at += len(own)
        gone = {i for i in np.flatnonzero(flags).tolist() if own[i]}
        dropped.append(len(gone))
        kept.append("\n".join(line for i, line in enumerate(text.split("\n")) if i not in gone) if gone else text)
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(list(map(len, keys)), pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.string())], ["doc_id", "n_lines", "n_dropped", "kept_text"])


def _sharded(refs: DataFrame, shards: int) -> DataFrame:
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = (halves(batch.column(0).to_pylist())[:, 0] % np.uint64(shards)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(of), batch.column(0), batch.column(1)], ["shard", "digest", "refs"])

    return refs.mapInArrow(number, "shard int, digest binary, refs long")


def _built(keys: DataFrame) -> DataFrame:
    """A filter for each shard; the keys of a shard are an even share of the digests."""

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        pairs, room = halves(list(rows["digest"])), len(rows)
        while not (made := CuckooFilter.sized(room)).add(pairs):
            room *= 2
        return pd.DataFrame({"shard": [int(rows["shard"].iloc[0])], "data": [made.dumps()]})

    return keys.select("shard", "digest").groupBy("shard").applyInPandas(build, "shard int, data binary")


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10, shards: int = 64, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_text: lines whose key stands in at least min_docs documents are dropped everywhere.

    Null and empty texts are one empty line, which stays. All rows of one id are one
    document, whatever their texts; a row without an id is one of its own. An empty table gives no rows; other columns are not read.
    """
    return LineIndex.of(docs, id_col, text_col, min_docs, shards).drop_lines(docs, id_col, text_col, broadcast_bytes)

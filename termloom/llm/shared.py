"""What several operators of this package need: settled tables, folds, components."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from functools import reduce
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that a broadcast may have at most; beyond it every operator has another way.
BROADCAST_BYTES = 64 << 20
_shipped: set[str] = set()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a local session without it gets one of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="corpus-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def settled(df: DataFrame, name: str) -> DataFrame:
    """df, written once to the shared folder and read back: its lineage ends there."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(key: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the key as text leaves `fold`; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % folds == fold


def labelled_sample(labels: DataFrame, key: str, label: str, folds: int, fold: int, rows: int) -> DataFrame:
    """At most `rows` training keys per label value, as (key, y); chosen by a hash, the same in every run.

    A key with several labels takes the smallest; null keys, null labels and the
    held-out fold are left out.
    """
    known = (
        labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("y"))
        .where(F.col("key").isNotNull() & F.col("y").isNotNull() & ~held_out(F.col("key"), folds, fold))
        .groupBy("key").agg(F.min("y").alias("y"))
    )
    return lowest(known.withColumn("mark", F.xxhash64("key")), "y", rows).select("key", "y")


def lowest(rows: DataFrame, value: str, most: int) -> DataFrame:
    """Of each value the `most` rows with the smallest hashes, then keys; rows: (key, mark, value), mark a 64-bit hash of the key.

    The values are few and counted; from their counts follows below which hash the rows
    that are wanted lie, so what comes together is a little more than that, however many
    tasks and rows there are.
    """
    counts = {r[0]: r[1] for r in rows.groupBy(value).count().collect()}
    room = 1.5 * most + 64
    while True:
        below = {v: int(-(1 << 63) + min(1.0, room / n) * (1 << 64)) - 1 for v, n in counts.items()}
        near = [rows.where((F.col(value) == v) & (F.col("mark") <= F.lit(min(b, (1 << 63) - 1)))) for v, b in sorted(below.items())]
        if not near:
            return rows.limit(0)
        found = {r[0]: r[1] for r in reduce(DataFrame.unionByName, near).groupBy(value).count().collect()}
        if all(found.get(v, 0) >= min(n, most) for v, n in counts.items()):
            return reduce(DataFrame.unionByName, [part.orderBy("mark", "key").limit(most) for part in near])
        room *= 4


def label_shares(labels: DataFrame, key: str, label: str, folds: int, fold: int) -> dict[int, int]:
    """Training rows of each label value, counted over the whole table."""
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & ~held_out(F.col(key), folds, fold))
    return {r[0]: r[1] for r in known.groupBy(F.col(label).cast("int")).count().collect()}


def few(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in views of at most so many: what a task makes of its texts at a time stays small, whatever Spark's batches hold."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """(rows, bounds of the groups of equal keys in them) from a stream sorted by keys; the last group waits for its end."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch])
        rows = rows if held is None else pa.concat_tables([held, rows])
        change = np.zeros(rows.num_rows, bool)
        change[0] = True
        for k in keys:
            column = rows.column(k).to_numpy()
            change[1:] |= column[1:] != column[:-1]
        bounds = np.flatnonzero(change)
        held = rows.slice(bounds[-1])
        if bounds[-1]:
            yield rows.slice(0, bounds[-1]), bounds
    if held is not None:
        yield held, np.array([0, held.num_rows])


def ship(spark: SparkSession) -> None:
    """Gives the executors this package, once for each application; a cluster's workers need not have it installed."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="code-")) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, str(path.relative_to(root.parent)))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def components(edges: DataFrame, name: str, most_rounds: int = 60) -> DataFrame:
    """Connected components of edges (a, b): (id, component), component the smallest id reached.

    Alternates hooking every neighbour, and the id itself, to the smallest id seen
    (first for the larger neighbours, then for the smaller ones). Each round is settled; it
    ends when a round changes nothing. Every step is an aggregate with a partial
    count, and no id gathers its neighbours in one row. Edges with a null end or
    equal ends are ignored.
    """
    links = edges.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))
    links = settled(links.where("lo < hi").distinct(), f"{name}-links")
    for _ in range(most_rounds):
        both = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            links.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # every larger neighbour of u, hooked to the smallest of u's neighbourhood
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).where("lo < hi").distinct()
        small_low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (
            large.join(small_low, "hi").select(F.explode(F.array(F.struct(F.col("lo").alias("x"), "m"), F.struct(F.col("hi").alias("x"), "m"))).alias("e"))
            .select(F.col("e.x").alias("hi"), F.col("e.m").alias("lo")).where("lo < hi").distinct()
        )
        after = settled(small, f"{name}-round")
        print_of = [F.count("*"), F.sum(F.xxhash64("lo", "hi") % (1 << 40))]
        same = after.agg(*print_of).first() == links.agg(*print_of).first()
        links = after
        if same:
            break
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    roots = links.select(F.col("lo").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return links.select(F.col("hi").alias("id"), F.col("lo").alias("component")).unionByName(roots)

"""Size checks that decide how a job is laid out.

Nothing is broadcast on trust: callers count what would be sent, and have a
shuffling way for everything beyond the limit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 128 * 1024 * 1024
BROADCAST_ROWS = 2_000_000

# A scan is spread over tasks of about this many input bytes, and over all cores at least; 0: none is spread.
SPREAD_BYTES = 2 * 1024 * 1024
# Sizes from here on are what Catalyst says of inputs that it knows nothing about.
UNKNOWN_BYTES = 1 << 50

# Bits of a key filter: 4096 bitmaps of 4 KB, whatever the number of keys.
FILTER_BITS = 4096 * 32768

# Copies of the small side when a hot key of the big side is split.
SALTS = 16


def fits_broadcast(rows: int, size: int, limit_bytes: int | None = None) -> bool:
    return size <= (BROADCAST_BYTES if limit_bytes is None else limit_bytes) and rows <= BROADCAST_ROWS


def plan_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate, or None where the session does not show plans."""
    plan = getattr(df, "_jdf", None)
    if plan is None:
        return None
    return int(str(plan.queryExecution().optimizedPlan().stats().sizeInBytes()))


def spread(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Spread an input over the cores by ``keys``, a large one by whole rows over more tasks.

    A task is a row group at least, and analysing a text takes far longer than moving it.
    Without this the longest task would grow with the files.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = plan_bytes(df)
    if size is None or size >= UNKNOWN_BYTES or not SPREAD_BYTES:
        return df
    tasks = -(-size // SPREAD_BYTES)
    if tasks <= cores:
        return df.repartition(2 * cores, *keys)
    # By whole rows, so that rows of one key do not come together.
    return df.repartition(max(2 * cores, tasks), F.xxhash64(*df.columns))


def in_blocks(df: DataFrame, *keys: str | Column, times: int = 1) -> tuple[DataFrame, int]:
    """``df`` with a number ``_block`` that follows from ``keys``, one task for each, and how many there are.

    What joins or groups by ``_block`` and more, and is dealt to as many blocks, needs no
    further shuffle. Blocks are as large as the tasks of ``spread``, or so many ``times`` larger.
    """
    spark = df.sparkSession
    blocks = 2 * spark.sparkContext.defaultParallelism
    size = plan_bytes(df)
    if size is None or size >= UNKNOWN_BYTES:
        blocks = max(blocks, int(spark.conf.get("spark.sql.shuffle.partitions")))
    else:
        blocks = max(blocks, -(-size // (times * max(1, SPREAD_BYTES))))
    block = F.pmod(F.xxhash64(*keys), F.lit(blocks)).cast("int")
    return df.withColumn("_block", block).repartitionById(blocks, F.col("_block")), blocks


def spread_batch(batch: DataFrame, *keys: str | Column) -> DataFrame:
    """Spread a micro-batch, whose size no plan knows, when it leaves cores idle."""
    cores = batch.sparkSession.sparkContext.defaultParallelism
    return batch if batch.rdd.getNumPartitions() >= cores else batch.repartition(2 * cores, *keys)


def _place(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys).bitwiseAND(F.lit(FILTER_BITS - 1))


def key_bitmaps(known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys of ``known``, hashed into bitmaps of 16 MB in all, each as 512 numbers of eight bytes."""
    bitmaps = (
        known.select(_place(keys).alias("_place"))
        .groupBy(F.expr("cast(_place div 32768 as int)").alias("_part"))
        .agg(F.bitmap_construct_agg(F.col("_place") % 32768).alias("_bytes"))
    )
    # A number is read where a byte would have to be cut out and spelled, for every row that is tested.
    numbers = "transform(sequence(0, 511), i -> cast(conv(hex(substring(_bytes, 8 * i + 1, 8)), 16, -10) as bigint))"
    return bitmaps.select("_part", F.expr(numbers).alias("_bits"))


def maybe_among(
    rows: DataFrame, known: DataFrame | None, keys: Sequence[str], bitmaps: DataFrame | None = None
) -> DataFrame:
    """``rows`` whose keys may be among those of ``known``; none that is gets lost.

    The bitmaps, made here or given, are broadcast, so most rows that an equi-join would
    drop are dropped before its shuffle.
    """
    if bitmaps is None:
        bitmaps = key_bitmaps(known, keys)
    placed = rows.withColumn("_place", _place(keys)).withColumn("_part", F.expr("cast(shiftright(_place, 15) as int)"))
    number = "get(_bits, cast(shiftright(_place, 6) & 511 as int))"
    # The first byte of a number is its highest.
    met = placed.join(F.broadcast(bitmaps), "_part").where(F.expr(f"getbit({number}, cast(_place & 63 ^ 56 as int)) = 1"))
    return met.select(*rows.columns)


def salted_join(
    big: DataFrame, small: DataFrame, keys: Sequence[str], salt_from: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Equi-join that cuts every key of ``big`` into ``SALTS`` parts."""
    big = big.withColumn("_salt", F.pmod(F.xxhash64(*salt_from), F.lit(SALTS)).cast("int"))
    small = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return big.join(small, [*keys, "_salt"], how).drop("_salt")

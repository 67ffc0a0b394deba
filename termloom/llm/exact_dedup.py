"""Exact duplicates by a content sort: equal texts come to stand side by side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.llm.shared import settled

#: Characters that do not count when texts are compared.
SPACES = " \t\n\x0b\f\r"
#: Texts that can be cut into parts; a row for each is broadcast.
MOST_HOT = 200_000


def without_spaces(rows: DataFrame, text: str, name: str) -> DataFrame:
    """rows with column `name`: the text without U+0020 and U+0009 to U+000D; the rare four are looked for before they are replaced."""
    rows = rows.withColumn(name, F.replace(F.replace(text, F.lit(" "), F.lit("")), F.lit("\n"), F.lit("")))
    rest: Column = F.col(name)
    some = F.lit(False)
    for c in "\t\x0b\f\r":
        rest, some = F.replace(rest, F.lit(c), F.lit("")), some | F.contains(F.col(name), F.lit(c))
    return rows.withColumn(name, F.when(some, rest).otherwise(F.col(name)))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot_share: float = 0.002, salts: int = 64, hot_rows: int = 20_000) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical without white space. Spark samples splitters of the
    normalised texts' first characters, and of a 64-bit hash behind them so that texts
    that begin alike are spread, too; it range-partitions and sorts by them and the
    text, and rows are compared with their neighbours over the full text. The splitters
    sent to the driver are short whatever the texts. Of equal texts the row with the
    most code points stays, then the smallest id.

    A text that more than `hot_share` of all rows have, or more than `hot_rows` of them
    however many rows there are, is cut into `salts` parts, and into more of them if they
    would hold more than `hot_rows` each, so no task gets them all. There are at most
    MOST_HOT such texts: beyond some billions of rows the limit rises with the table.
    The parts' winners are then compared once more. Copies of a hot text are found by the count of a
    64-bit hash; a collision only salts a row that need not be.

    Null text counts as empty, and all empty texts are equal. Of rows equal in text,
    length and id, one stays. A null id loses against any other. An empty table gives
    no rows; other columns are not read.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("raw"))
    base = without_spaces(base, "raw", "body").select("doc_id", "body", F.char_length("raw").alias("points"))
    total = docs.count()
    limit = max(min(total * hot_share, hot_rows), total / MOST_HOT, 2.0)
    hot = settled(
        base.groupBy(F.xxhash64("body").alias("mark")).agg(F.count("*").alias("n"))
        .where(F.col("n") > F.lit(limit))
        .select("mark", F.lit(True).alias("hot"), F.greatest(F.lit(salts), F.ceil(F.col("n") / hot_rows)).alias("parts")), "hot-texts")
    salted = base.withColumn("mark", F.xxhash64("body")).join(F.broadcast(hot), "mark", "left").select(
        "doc_id", "body", "points", "mark", F.substring("body", 1, 32).alias("begin"), F.coalesce("hot", F.lit(False)).alias("hot"),
        F.when(F.col("hot"), F.pmod(F.xxhash64("doc_id"), F.col("parts"))).otherwise(F.lit(0)).cast("int").alias("salt"))

    best_first = [F.col("points").desc(), F.col("doc_id").asc_nulls_last()]
    group = Window.partitionBy("begin", "mark", "salt", "body")
    ordered = group.orderBy(*best_first)
    found = settled(
        salted.repartitionByRange("begin", "mark", "salt").select(
            "doc_id", "hot", F.sha2("body", 256).alias("text_sha256"),
            F.row_number().over(ordered).alias("nth"),
            F.first("doc_id").over(ordered).alias("head"), F.first("points").over(ordered).alias("head_points"),
            F.count("*").over(group).alias("size")), "content-sort")

    heads = found.where("hot AND nth = 1").select("text_sha256", "head", "head_points", "size")
    over = Window.partitionBy("text_sha256").orderBy(F.col("head_points").desc(), F.col("head").asc_nulls_last())
    merged = heads.select(
        "text_sha256", F.row_number().over(over).alias("nth"), F.col("head").alias("all_head"),
        F.sum("size").over(Window.partitionBy("text_sha256")).alias("all_size")).where("nth = 1").drop("nth")
    joined = found.join(F.broadcast(merged), "text_sha256", "left")  # at most MOST_HOT rows
    own = F.col("all_size").isNull()
    keep = F.when(own, F.col("head")).otherwise(F.col("all_head"))
    return joined.select(
        "doc_id", keep.alias("keep_id"), F.when(own, F.col("size")).otherwise(F.col("all_size")).cast("long").alias("group_size"),
        ((F.col("nth") == 1) & F.col("head").eqNullSafe(keep)).alias("kept"), "text_sha256")

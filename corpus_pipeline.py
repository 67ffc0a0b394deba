"""A training corpus from raw documents, in five stages.

Every stage is written as Parquet to the shared folder and read again as the next
one's input. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm import decontaminate, toxicity
from termloom.llm.jaccard_join import near_duplicates
from termloom.llm.line_dedup import LineIndex
from termloom.llm.packing import pack
from termloom.llm.queries import table, tokenizer_file
from termloom.llm.shared import settled, ship

#: Toxicity is learned, so SQL cannot give these rows; tests/llm compares each stage with a plain computation.
ORACLE_SQL = None


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go. The classifier learns from the labelled ones of docs outside the held-out fold."""
    ship(spark)
    model, _ = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model, threshold=0.5)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more go; every document stays, with the lines it keeps and their length."""
    ship(spark)
    return LineIndex.of(docs, min_docs=10).rewrite(docs)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by a Jaccard similarity of 0.8 over shingles of five words the smallest doc_id stays."""
    ship(spark)
    others = near_duplicates(docs, size=5, percent=80).where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(others, "doc_id", "left_anti").select(docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold four fifths of the shingles of a benchmark item go."""
    ship(spark)
    found = decontaminate.find_items(docs, table(spark, sf_dir, "benchmark"), share=0.8, size=5)
    return docs.join(found.select("doc_id").distinct(), "doc_id", "left_anti").select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 tokens; one row per piece of a document."""
    ship(spark)
    return pack(docs.select("doc_id", F.col("text")), tokenizer_file(), size=2048, end_id=0)


STAGES = [
    ("toxicity", without_toxic),
    ("line dedup", without_repeated_lines),
    ("n-gram Jaccard join", without_near_duplicates),
    ("benchmark decontamination", without_benchmark),
    ("best-fit packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settled(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs

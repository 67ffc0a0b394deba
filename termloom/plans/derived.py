"""The tables of the data model, derived from the given tables.

Catalog, terms, stored matches and term sources grow with the data. The fixture
dictionaries are fixed and are only ever matched against whole document tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom import schemas
from termloom.operators.terms import Tables

# The fixture dictionaries (id, name, case_sensitive, word_stemming)
# and their terms (dictionary, term, classification).
FIXTURE_DICTIONARIES = [
    (1, "phrases", False, False),
    (2, "cased", True, False),
    (3, "stemmed", False, True),
    (4, "cased_stem", True, True),
]
FIXTURE_TERMS = [
    (1, "anea eriner", ["attion of thanedble"]),
    (1, "attion of thanedble", []),
    (1, "orre orre", ["hehely"]),
    (1, "hehely", []),
    (1, "from", ["from"]),
    (1, "the", []),
    (1, "zzz absent", []),
    (2, "THE", []),
    (2, "AND", []),
    (2, "Anea Eriner", []),
    (2, "anea eriner", ["THE"]),
    (2, "er/ha", []),
    (3, "er", []),
    (3, "hehely", []),
    (3, "anea eriners", ["from", "er"]),
    (4, "Er", []),
    (4, "ER", []),
]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.expr("timestamp'2020-01-01 00:00:00' + make_dt_interval(cast(doc_id % 365 as int))")
    return read(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("docid"), F.col("text").alias("contents"), "source", day.alias("time")
    )


def sentences(spark: SparkSession, sf_dir: str, nlp_type: str = "nlp") -> DataFrame:
    """Three ways to cut all documents: at line ends, at full stops, at both."""
    border = {"nlp": "\n", "nlp352": "[.]", "nlp360": "[.\n]"}[nlp_type]
    docs = read(spark, sf_dir, "documents")
    lines = docs.select(F.col("doc_id").alias("docid"), F.posexplode(F.split("text", border)))
    return lines.select(
        "docid", (F.col("pos") + 1).alias("sentid"), F.split("col", " ").alias("words"),
        F.lit(nlp_type).alias("nlp_type"),
    )


def fixture_dictionaries(spark: SparkSession) -> DataFrame:
    rows = [
        (i, name, f"{name}.csv", None, None, name, None, cased, stemmed, None, None, None)
        for i, name, cased, stemmed in FIXTURE_DICTIONARIES
    ]
    return spark.createDataFrame(rows, schemas.DICTIONARIES).coalesce(1)


def fixture_terms(spark: SparkSession, dict_id: int | None = None) -> DataFrame:
    rows = [(*row, None) for row in FIXTURE_TERMS if dict_id in (None, row[0])]
    return spark.createDataFrame(rows, schemas.DICT_TERMS).coalesce(1)


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One dictionary per supplier."""
    key = F.col("s_suppkey")
    nations = read(spark, sf_dir, "nation")
    joined = read(spark, sf_dir, "supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    day = F.expr("timestamp'2020-01-01 00:00:00' + make_dt_interval(cast(s_suppkey as int))")
    return joined.select(
        key.cast("int").alias("dict_id"),
        F.col("s_name").alias("name"),
        F.concat(F.lit("lists/"), F.lower("s_name"), F.lit(".csv")).alias("source"),
        F.lit(None).cast("string").alias("key"),
        F.lit(None).cast("array<string>").alias("json_path"),
        F.col("n_name").alias("base_classification"),
        F.lit(None).cast("array<string>").alias("classification_path"),
        (F.col("s_acctbal") > 5000).alias("case_sensitive"),
        (key % 2 == 0).alias("word_stemming"),
        F.lit(None).cast("string").alias("users"),
        day.alias("last_updated"),
        F.lit(None).cast("timestamp").alias("last_matched"),
    )


def spoken_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(dict_id, term, classification, role): the pairs of neighbouring words of all turns.

    A turn of one word gives that word. The word after a user's pair classifies it.
    """
    words = F.regexp_extract_all("text", F.lit(r"[\p{L}\p{N}]+"), F.lit(0)).alias("words")
    words = read(spark, sf_dir, "conversations").select("conv_id", "role", words)
    last = F.greatest(F.size("words") - 1, F.lit(1))
    starts = words.where(F.size("words") > 0).withColumn("at", F.explode(F.sequence(F.lit(1), last)))
    other = F.when(F.col("role") == "user", F.slice("words", F.col("at") + 2, 1)).otherwise(
        F.array().cast("array<string>")
    )
    return starts.select(
        (F.col("conv_id") % 10).cast("int").alias("dict_id"),
        F.array_join(F.slice("words", F.col("at"), 2), " ").alias("term"),
        other.alias("classification"),
        "role",
    )


def spoken_dict_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spoken_terms(spark, sf_dir).select("dict_id", "term", "classification").distinct()
    return rows.withColumn("last_updated", F.lit(None).cast("timestamp"))


def part_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(dict_id, term, classification, brand): one term per kind of part."""
    return read(spark, sf_dir, "part").select(
        (F.col("p_partkey") % 10).cast("int").alias("dict_id"),
        F.concat_ws("/", "p_name", "p_type").alias("term"),
        F.array("p_brand").alias("classification"),
        F.col("p_brand").alias("brand"),
    ).distinct()


def part_dict_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = part_terms(spark, sf_dir).select("dict_id", "term", "classification")
    return rows.withColumn("last_updated", F.lit(None).cast("timestamp"))


def line_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``terms_docs`` rows: a part's term in an order, stamped with the ship date."""
    parts = read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.concat_ws("/", "p_name", "p_type").alias("term")
    )
    lines = read(spark, sf_dir, "lineitem").join(parts, "l_partkey")
    return lines.select(
        "term",
        F.col("l_orderkey").alias("docid"),
        F.col("l_quantity").cast("int").alias("hits"),
        F.col("l_shipdate").cast("timestamp").alias("last_updated"),
        F.when(F.col("l_returnflag") != "R", F.col("l_returnflag") == "A").alias("hierarchy_present"),
        (F.col("l_suppkey") % 10).cast("int").alias("dict_id"),
        (F.col("l_linestatus") == "O").alias("from_percolation"),
    )


def line_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``terms_docs_sentences`` rows: the same, per line number."""
    parts = read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), F.concat_ws("/", "p_name", "p_type").alias("term")
    )
    lines = read(spark, sf_dir, "lineitem").join(parts, "l_partkey")
    return lines.select(
        "term", F.col("l_orderkey").alias("docid"), F.col("l_linenumber").alias("sentid"),
        F.col("l_shipdate").cast("string").alias("snippets"),
    )


def no_stored_queries(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], schemas.STORED_QUERIES)


def subset_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("int").alias("dict_id"), F.concat("s_name", F.lit("_nlp")).alias("subset_name")
    )


def part_tables(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(
        dictionaries=catalog(spark, sf_dir),
        dict_terms=part_dict_terms(spark, sf_dir),
        terms_docs=line_matches(spark, sf_dir),
        terms_docs_sentences=line_sentences(spark, sf_dir),
        stored_queries=no_stored_queries(spark),
        subset_meta=subset_meta(spark, sf_dir),
    )


def spoken_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """Dictionaries whose stored terms are what users say."""
    said = spoken_terms(spark, sf_dir).where(F.col("role") == "user")
    stored = said.select("dict_id", "term", "classification").distinct()
    return Tables(
        dictionaries=catalog(spark, sf_dir),
        dict_terms=stored.withColumn("last_updated", F.lit(None).cast("timestamp")),
        terms_docs=line_matches(spark, sf_dir),
        terms_docs_sentences=line_sentences(spark, sf_dir),
        stored_queries=no_stored_queries(spark),
    )


def answered_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(term, classification): a new source, what assistants say."""
    said = spoken_terms(spark, sf_dir).where(F.col("role") == "assistant")
    return said.select("term", "classification")

"""Each operator over its whole table, with production parameters, and what SQL gives for it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm import conversations, decontaminate, language, licenses, pieces, pii, quality, toxicity, whitening
from termloom.llm.exact_dedup import exact_duplicates
from termloom.llm.jaccard_join import near_duplicates
from termloom.llm.line_dedup import drop_repeated_lines
from termloom.llm.packing import pack
from termloom.llm.shared import settled, ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def piece_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_subword_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")), threshold=0.3)


def op2_feistel_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key is a parameter of the operator; this one makes the query repeatable."""
    return pii.pseudonymise(table(spark, sf_dir, "documents"), key="corpus-2")


def op3_count_vector_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), size=4, percent=85)


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"), percent=80).drop("blocks")


def op5_bin_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer_file(), size=2048, end_id=0)


def op6_weak_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model, _ = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, threshold=0.5)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_repeated_lines(table(spark, sf_dir, "documents"), min_docs=10)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op8_content_sort_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


def op9_compression_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.predict(docs, language.fit(docs))


def op10_benchmark_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that hold at least four fifths of an item's shingles of five words, with the item."""
    return decontaminate.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), share=0.8, size=5)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The damaged conversations' cheapest repair; one of which no row is left has zeros and the hash of nothing."""
    given = table(spark, sf_dir, "conversations")
    rows = conversations.damaged(given)
    found = conversations.digests(rows, settled(conversations.audits(rows), "audits")).withColumnRenamed("conv_id", "_conv")
    every = given.select("conv_id").distinct()
    joined = every.join(found, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
    numbers = [F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return joined.select("conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op12_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the pieces their number and hash, of the texts they give the hash, and of the places where they start."""
    path = piece_file()
    decoded = pieces.decode(pieces.encode(table(spark, sf_dir, "documents"), path), path)
    return decoded.select(
        "doc_id", F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"), F.sha2("starts", 256).alias("starts_sha256"))


def op13_polarisation_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A deviation beyond a long is null there, and whole in exact_deviation."""
    vectors = table(spark, sf_dir, "embeddings")
    model = whitening.fit(vectors, most=32)
    out = whitening.transform(vectors, model)
    return out.select(
        "vec_id", "component", "n", F.expr("try_cast(deviation AS bigint)").alias("deviation"), "whitened", "explained",
        F.lit(whitening.identity_error(vectors, model)).alias("identity_error"), F.col("deviation").alias("exact_deviation"))


QUERIES = {
    "op1_subword_quality": op1_subword_quality,
    "op2_feistel_pii": op2_feistel_pii,
    "op3_count_vector_join": op3_count_vector_join,
    "op4_license_scan": op4_license_scan,
    "op5_bin_slack_packing": op5_bin_slack_packing,
    "op6_weak_toxicity": op6_weak_toxicity,
    "op7_line_dedup": op7_line_dedup,
    "op8_content_sort_dedup": op8_content_sort_dedup,
    "op9_compression_language": op9_compression_language,
    "op10_benchmark_containment": op10_benchmark_containment,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_piece_encoding": op12_piece_encoding,
    "op13_polarisation_whitening": op13_polarisation_whitening,
}

_SPACES = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLES = {
    "op3_count_vector_join": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), shingles AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                ELSE list_transform(generate_series(1, len(w) - 3), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s
            FROM words
        ), sizes AS (
            SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
        ), pairs AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
        ), links AS (
            SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)
        ), neighbours AS (
            SELECT a, b FROM links UNION ALL SELECT b, a FROM links
        ), reached AS (
            SELECT doc_id AS id, doc_id AS c FROM documents
            UNION SELECT neighbours.b, reached.c FROM reached JOIN neighbours ON neighbours.a = reached.id WHERE reached.c < neighbours.b
        )
        SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(c) AS component_id
        FROM reached JOIN documents ON id = documents.doc_id LEFT JOIN sizes USING (doc_id) GROUP BY doc_id""",
    "op10_benchmark_containment": r"""
        WITH items AS (
            SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM benchmark
        ), sized AS (
            SELECT item_id, w, least(5, len(w)) AS m FROM items WHERE len(w) > 0
        ), asked AS (
            SELECT DISTINCT item_id, m, unnest(list_transform(generate_series(1, len(w) - m + 1), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS s FROM sized
        ), words AS (
            SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents
        ), held AS (
            SELECT DISTINCT doc_id, m, unnest(list_transform(generate_series(1, len(w) - m + 1), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS s
            FROM words, (SELECT DISTINCT m FROM sized)
        ), counts AS (
            SELECT item_id, count(*) AS n FROM asked GROUP BY item_id
        )
        SELECT doc_id, item_id, count(*) / any_value(n)::DOUBLE AS containment
        FROM asked JOIN held USING (m, s) JOIN counts USING (item_id) GROUP BY doc_id, item_id HAVING count(*) >= 0.8 * any_value(n) - 1e-9""",
    "op7_line_dedup": rf"""
        WITH lines AS (
            SELECT doc_id, generate_subscripts(parts, 1) AS place, unnest(parts) AS line
            FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
        ), keyed AS (
            SELECT *, translate(trim(line, {_SPACES}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines
        ), often AS (
            SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10
        ), marked AS (
            SELECT keyed.*, often.k IS NOT NULL AS gone FROM keyed LEFT JOIN often ON keyed.k = often.k
        )
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM marked GROUP BY doc_id""",
    "op8_content_sort_dedup": rf"""
        WITH bodies AS (
            SELECT doc_id, length(coalesce(text, '')) AS points,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body FROM documents
        ), ranked AS (
            SELECT *, first_value(doc_id) OVER (PARTITION BY body ORDER BY points DESC, doc_id) AS keep_id,
                   count(*) OVER (PARTITION BY body) AS group_size FROM bodies
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM ranked""",
}

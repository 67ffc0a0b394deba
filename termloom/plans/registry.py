"""One query per operator, over whole tables.

Every function takes the session and the folder of the given tables. Arrays and
timestamps are shown as text, so that engines can be compared value by value.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.functions import text as T
from termloom.operators import catalog, matching, phrase, postings, quality, subsets, terms, upsert
from termloom.operators.bounds import spread
from termloom.operators.sentences import match_sentences
from termloom.operators.terms import Tables
from termloom.plans import derived
from termloom.plans.corpus import Corpus
from termloom.sources import files, tables
from termloom.sources.scratch import scratch_path, settle, write_parquet
from termloom.streaming import percolate as P

AS_OF = dt.datetime(2024, 1, 1)
SINCE = dt.datetime(2020, 6, 1, 13, 30)


def _list(column: str) -> Column:
    return F.array_join(column, "|").alias(column)


def _time(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)


# Matching


def match_field(field: str, dict_id: int):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Terms of one fixture dictionary in all documents."""
        return matching.match_terms(
            derived.articles(spark, sf_dir), derived.fixture_terms(spark, dict_id), field
        )

    return query


def _fixture_matches(spark: SparkSession, sf_dir: str, from_date: dt.datetime | None = None) -> DataFrame:
    return matching.match_terms_to_docs(
        derived.fixture_terms(spark), derived.fixture_dictionaries(spark),
        derived.articles(spark, sf_dir), AS_OF, from_date,
    )


def match_by_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fixture_matches(spark, sf_dir).select("dict_id", "term", "docid", "hits")


def match_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fixture_matches(spark, sf_dir).select("dict_id", "term", "docid", "hits", "hierarchy_present")


def match_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fixture_matches(spark, sf_dir, SINCE).select("dict_id", "term", "docid", "hits")


def catch_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every dictionary was last matched on a day of its own."""
    month = F.make_timestamp(F.lit(2020), F.col("dict_id") * 2, F.lit(15), F.lit(7), F.lit(0), F.lit(0))
    own = derived.fixture_terms(spark).withColumn("last_updated", month)
    rows = matching.catch_up(
        own, derived.fixture_dictionaries(spark), derived.articles(spark, sf_dir), AS_OF
    )
    return rows.select("dict_id", "term", "docid", "hits", "hierarchy_present")


def _spoken_matches(
    spark: SparkSession, sf_dir: str, from_date: dt.datetime | None = None, by_term: bool = False,
    among: DataFrame | None = None,
) -> DataFrame:
    return matching.match_terms_to_docs(
        derived.spoken_dict_terms(spark, sf_dir), derived.catalog(spark, sf_dir),
        derived.articles(spark, sf_dir), AS_OF, from_date, by_term=by_term, among=among,
    )


def match_spoken_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dictionary that grows with the data."""
    return _spoken_matches(spark, sf_dir).select("dict_id", "term", "docid", "hits", "hierarchy_present")


def highlight_snippets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase.highlight_snippets(
        derived.articles(spark, sf_dir), derived.fixture_terms(spark, 1), T.NO_STEM, context=2
    )


# Text analysis


def tokenize_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = derived.articles(spark, sf_dir)
    return docs.select("docid", F.size(T.tokenize("contents")).alias("n_tokens"))


def analyze_field(field: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        """All tokens of all documents; a hole is shown as an underscore."""
        docs = spread(derived.articles(spark, sf_dir).select("docid", "contents"), "docid")
        toks = F.array_join(T.analyze(field, "contents"), " ", "_")
        return docs.select("docid", toks.alias("toks"))

    return query


def strip_possessive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Possessives of all spoken words, in both spellings."""
    said = derived.read(spark, sf_dir, "conversations")
    owned = F.regexp_replace("text", " ", F.when(F.col("role") == "user", "'s ").otherwise("’S "))
    toks = said.select("conv_id", "turn", owned.alias("text")).select(
        "conv_id", "turn", T.tokenize("text").alias("toks")
    )
    bare = F.expr(f"transform(toks, t -> {T.strip_possessive_sql('t')})")
    return toks.select("conv_id", "turn", F.array_join(bare, " ").alias("stripped"))


# Catalog


def list_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.list_terms(
        derived.catalog(spark, sf_dir), derived.part_dict_terms(spark, sf_dir), "supplier#00000000_"
    )


def list_dicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.list_dicts(derived.catalog(spark, sf_dir)).select("dict_id", "name", _time("last_updated"))


def list_dicts_verbose(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = catalog.list_dicts(derived.catalog(spark, sf_dir), verbose=True)
    return rows.select(
        "dict_id", "name", "source", "base_classification", "case_sensitive", "word_stemming",
        _time("last_updated"),
    )


_META = ["dict_id", "name", "source", "base_classification", "case_sensitive", "word_stemming"]


def dict_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.get_dictionary_metadata(derived.catalog(spark, sf_dir), "Supplier#000000003").select(*_META)


def dict_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.get_dictionary_metadata_by_id(derived.catalog(spark, sf_dir), 5).select(*_META)


def similar_dicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = catalog.find_similar_dictionaries(derived.catalog(spark, sf_dir), "00007", "supplier#00000001_.CSV", "tion_2")
    return rows.select("dict_id", "name", "source", "base_classification")


def add_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = {"dict_id": 100000, "name": "minerals", "source": "minerals.csv", "base_classification": "rock"}
    rows = catalog.add_dictionary(derived.catalog(spark, sf_dir), row)
    return rows.select("dict_id", "name", "source", "base_classification", "case_sensitive")


def contents_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.contents_fields(derived.catalog(spark, sf_dir))


# Term sources and their differences


def csv_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = derived.read(spark, sf_dir, "part")
    line = F.concat(F.lit("\t"), "p_name", F.lit(" , "), "p_type", F.lit(",,"), "p_brand", F.lit(", "))
    return files.parse_terms_csv(parts.select(line.alias("value"))).select("term", _list("classification"))


def json_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = derived.read(spark, sf_dir, "part")
    text = F.format_string(
        '{"success":{"data":[{"nam":"%s","a":{"b":"%s"}},{"nam":"%s"}]}}', "p_name", "p_brand", "p_type"
    )
    rows = files.parse_terms_json(parts.select(text.alias("value")), ["success", "data"], "nam", ["a.b"])
    return rows.select("term", _list("classification"))


def _said(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    existing = derived.spoken_tables(spark, sf_dir).dict_terms
    return existing, terms.incoming_pairs(derived.answered_terms(spark, sf_dir))


def terms_to_add(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.terms_to_add(*_said(spark, sf_dir))


def terms_to_remove(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.terms_to_remove(*_said(spark, sf_dir))


def pairs_to_add(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.pairs_to_add(*_said(spark, sf_dir)).select("term", _list("classification"))


def pairs_to_remove(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.pairs_to_remove(*_said(spark, sf_dir)).select("term", _list("classification"))


def _terms_of(tables_: Tables) -> DataFrame:
    return tables_.dict_terms.select("dict_id", "term", _list("classification"), _time("last_updated"))


def ingest_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    incoming = derived.answered_terms(spark, sf_dir)
    return _terms_of(terms.ingest(derived.spoken_tables(spark, sf_dir), 3, incoming, as_of=AS_OF))


def ingest_terms_anew(spark: SparkSession, sf_dir: str) -> DataFrame:
    incoming = derived.answered_terms(spark, sf_dir)
    return _terms_of(terms.ingest(derived.spoken_tables(spark, sf_dir), 3, incoming, update=True, as_of=AS_OF))


def update_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    incoming = derived.answered_terms(spark, sf_dir)
    return _terms_of(terms.update(derived.spoken_tables(spark, sf_dir), 3, incoming, as_of=AS_OF))


# Keyed changes


def upsert_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = derived.line_matches(spark, sf_dir)
    new = F.col("from_percolation")
    out = upsert.upsert_terms_docs(rows.where(~new), rows.where(new))
    return out.withColumn("last_updated", _time("last_updated"))


def upsert_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = derived.articles(spark, sf_dir).select("docid", "contents")
    items = derived.read(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("docid"), F.col("text").alias("contents")
    )
    return upsert.upsert_documents(docs, items).select("docid", F.length("contents").alias("n_chars"))


def _rest(tables_: Tables, *kinds: str) -> DataFrame:
    """What is left of several tables, one below the other."""
    views = {
        "dict_terms": tables_.dict_terms.select("dict_id", F.col("term").alias("item")),
        "terms_docs": tables_.terms_docs.select("dict_id", F.concat_ws("@", "term", "docid").alias("item")),
        "terms_docs_sentences": tables_.terms_docs_sentences.select(
            F.lit(None).cast("int").alias("dict_id"), F.concat_ws("@", "term", "docid", "sentid").alias("item")
        ),
        "stored_queries": tables_.stored_queries.select("dict_id", F.col("id").alias("item")),
        "dictionaries": tables_.dictionaries.select("dict_id", F.col("name").alias("item")),
    }
    if tables_.subset_meta is not None:
        views["subset_meta"] = tables_.subset_meta.select("dict_id", F.col("subset_name").alias("item"))
    out = None
    for kind in kinds:
        rows = views[kind].select(F.lit(kind).alias("kind"), "dict_id", "item")
        out = rows if out is None else out.unionByName(rows)
    return out


def _registered(tables_: Tables) -> Tables:
    stored = terms.register_queries(tables_.stored_queries, tables_.dict_terms, tables_.dictionaries)
    return replace(tables_, stored_queries=stored)


def delete_term(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delete all terms of one brand from its dictionaries."""
    doomed = derived.part_terms(spark, sf_dir).where(F.col("brand") == "Brand#17")
    rest = terms.delete_terms(_registered(derived.part_tables(spark, sf_dir)), doomed)
    return _rest(rest, "dict_terms", "terms_docs", "terms_docs_sentences", "stored_queries")


def remove_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = terms.remove_dictionary(_registered(derived.part_tables(spark, sf_dir)), "supplier#000000004")
    return _rest(
        rest, "dictionaries", "dict_terms", "terms_docs", "terms_docs_sentences", "stored_queries", "subset_meta"
    )


def touch_dictionaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = F.col("base_classification") == "NATION_3"
    rows = upsert.touch(derived.catalog(spark, sf_dir), chosen, "last_matched", AS_OF)
    return rows.select("dict_id", _time("last_updated"), _time("last_matched"))


# Sentences and subsets


def sentence_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentence rows of one dictionary; documents of one source have theirs already."""
    matches = _fixture_matches(spark, sf_dir)
    known = derived.articles(spark, sf_dir).where(F.col("source") == "src3")
    done = known.select(F.lit("from").alias("term"), "docid")
    return match_sentences(
        derived.sentences(spark, sf_dir), matches, derived.fixture_terms(spark, 1), done
    )


def sentence_matches_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms of all fixture dictionaries, taken as regular expressions."""
    matches = _fixture_matches(spark, sf_dir)
    none = matches.select("term", "docid").where(F.lit(False))
    return match_sentences(
        derived.sentences(spark, sf_dir), matches, derived.fixture_terms(spark), none, regex_terms=True
    )


def subset(nlp_type: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        matches = _fixture_matches(spark, sf_dir)
        return subsets.subset(
            derived.sentences(spark, sf_dir, nlp_type), matches, derived.fixture_terms(spark), 1
        )

    return query


def _overlap(spark: SparkSession, sf_dir: str, terms_1: list[str], terms_2: list[str]) -> DataFrame:
    dictionaries, rows = derived.fixture_dictionaries(spark), derived.fixture_terms(spark)
    return subsets.overlap(
        derived.sentences(spark, sf_dir), _fixture_matches(spark, sf_dir),
        subsets.term_set(spark, dictionaries, rows, "phrases", terms_1),
        subsets.term_set(spark, dictionaries, rows, "stemmed", terms_2),
    )


def overlap_all_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _overlap(spark, sf_dir, [], [])


def overlap_listed_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _overlap(spark, sf_dir, ["from"], ["er", "THE"])


def subset_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = subsets.register_subset(derived.subset_meta(spark, sf_dir), 3, "Supplier#000000003_nlp")
    return subsets.register_subset(meta, 0, "Supplier#000000005_nlp")


# Stored queries and percolation


def stored_query_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = terms.register_queries(
        derived.no_stored_queries(spark), derived.part_dict_terms(spark, sf_dir), derived.catalog(spark, sf_dir)
    )
    return rows.select("id", "term", _list("classification"), "field")


def missing_stored_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    all_terms = derived.part_dict_terms(spark, sf_dir)
    old = F.array_contains("classification", "Brand#17")
    stored = terms.register_queries(
        derived.no_stored_queries(spark), all_terms.where(~old), derived.catalog(spark, sf_dir)
    )
    return terms.missing_queries(stored, all_terms)


def unregister_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    all_terms = derived.part_dict_terms(spark, sf_dir)
    stored = terms.register_queries(
        derived.no_stored_queries(spark), all_terms, derived.catalog(spark, sf_dir)
    )
    old = all_terms.where(F.array_contains("classification", "Brand#17"))
    return terms.unregister_queries(stored, old).select("id")


def _fixture_queries(spark: SparkSession) -> DataFrame:
    return terms.register_queries(
        derived.no_stored_queries(spark), derived.fixture_terms(spark), derived.fixture_dictionaries(spark)
    )


def percolate_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = P.compile_stored(_fixture_queries(spark))
    return P.matching_ids(P.percolate(derived.articles(spark, sf_dir), stored)).select("docid", _list("ids"))


def _arriving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as a stream of files."""
    schema = derived.read(spark, sf_dir, "documents").schema
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", 1000)
        .parquet(f"{sf_dir}/documents*.parquet")
        .select(F.col("doc_id").alias("docid"), F.col("text").alias("contents"))
    )


def _streamed(spark: SparkSession, sf_dir: str) -> str:
    """The log of a stream's matches."""
    log = scratch_path(spark, "percolated")
    P.percolate_stream(
        _arriving(spark, sf_dir), _fixture_queries(spark), log, scratch_path(spark, "offsets"), AS_OF
    ).awaitTermination()
    return log


_PERCOLATED = ["term", "docid", "hits", "hierarchy_present", "dict_id", "from_percolation"]


def percolate_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = spark.createDataFrame(
        [], "term string, docid long, hits int, last_updated timestamp, hierarchy_present boolean, "
        "dict_id int, from_percolation boolean",
    ).schema
    return P.read_log(spark, _streamed(spark, sf_dir), stored).select(*_PERCOLATED)


def fold_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of a stream brought into the matches stored since a date."""
    stored = _fixture_matches(spark, sf_dir, SINCE)
    return P.fold_log(stored, _streamed(spark, sf_dir)).select(*_PERCOLATED)


def match_kept_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches since a date, looked up in postings that were written before."""
    docs = derived.articles(spark, sf_dir)
    forms, kept = scratch_path(spark, "analyzed"), scratch_path(spark, "postings")
    write_parquet(phrase.analyze_documents(docs, T.FIELDS, carried=["time"]), forms, ["field"])
    postings.write_postings(spark.read.parquet(forms), kept)
    rows = matching.match_terms_to_docs(
        derived.fixture_terms(spark), derived.fixture_dictionaries(spark), docs, AS_OF, SINCE,
        postings=spark.read.parquet(kept),
    )
    return rows.select("dict_id", "term", "docid", "hits", "hierarchy_present")


# A corpus


def _corpus(spark: SparkSession, sf_dir: str) -> tuple[Corpus, DataFrame]:
    """A corpus of its own with the fixture dictionaries, and the documents that it may index."""
    path = scratch_path(spark, "corpus")
    name = path.rpartition("/")[2].replace("-", "_")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
    corpus = Corpus(spark, name)
    own, dictionaries = derived.fixture_terms(spark), derived.fixture_dictionaries(spark)
    corpus.save({
        "dictionaries": dictionaries, "dict_terms": own,
        "stored_queries": terms.register_queries(derived.no_stored_queries(spark), own, dictionaries),
    })
    docs = derived.articles(spark, sf_dir).select(F.col("docid").cast("string").alias("docid"), "contents", "time")
    return corpus, docs


def _stored(corpus: Corpus) -> DataFrame:
    return corpus.table("terms_docs").withColumn("docid", F.col("docid").cast("long"))


def corpus_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents indexed in two parts, of which the second replaces some of the first, then matched."""
    corpus, docs = _corpus(spark, sf_dir)
    corpus.index_documents(docs.where(F.col("time") < SINCE).withColumn("contents", F.lower("contents")))
    corpus.index_documents(docs)
    for _, name, _, _ in derived.FIXTURE_DICTIONARIES:
        corpus.match_documents(name, as_of=AS_OF)
    return _stored(corpus).select("dict_id", "term", "docid", "hits", "hierarchy_present")


def corpus_fix_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches of old documents, brought up to date when the check finds more."""
    corpus, docs = _corpus(spark, sf_dir)
    corpus.index_documents(docs.where(F.col("time") < SINCE))
    corpus.match_documents("phrases", as_of=AS_OF)
    corpus.index_documents(docs.where(F.col("time") >= SINCE))
    corpus.check_freshness("phrases", fix=True, as_of=AS_OF)
    return _stored(corpus).select("dict_id", "term", "docid", "hits", "hierarchy_present")


def corpus_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream's log folded into newer matches of one dictionary, of which a term was deleted meanwhile."""
    corpus, docs = _corpus(spark, sf_dir)
    corpus.index_documents(docs)
    log = scratch_path(spark, "percolated")
    P.percolate_stream(
        _arriving(spark, sf_dir).withColumn("docid", F.col("docid").cast("string")), corpus.table("stored_queries"),
        log, scratch_path(spark, "offsets"), AS_OF,
    ).awaitTermination()
    corpus.match_documents("phrases", from_date=SINCE, as_of=AS_OF + dt.timedelta(days=1))
    corpus.delete_term(1, "hehely")
    corpus.fold_log(log)
    return _stored(corpus).select(*_PERCOLATED)


# Lookups and quality


def doc_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = derived.read(spark, sf_dir, "labels").select((F.col("doc_id") * 3).alias("docid")).distinct()
    return tables.doc_exists(wanted, derived.articles(spark, sf_dir))


def scan_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.scan_matching(
        derived.articles(spark, sf_dir), F.col("source") == "src3", 50
    ).select("docid")


def sample_terms_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the terms, at most five of a dictionary."""
    rows = quality.sample_terms(derived.part_dict_terms(spark, sf_dir), 0.5, 5, by_hash=True)
    return rows.select("dict_id", "term")


def unmatched_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = derived.spoken_dict_terms(spark, sf_dir)
    rows = quality.terms_without_matches(own, _spoken_matches(spark, sf_dir, SINCE, by_term=True))
    return rows.select("dict_id", "term")


def stored_live_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was stored since a date against all documents."""
    return quality.compare_stored_live(
        derived.articles(spark, sf_dir), derived.fixture_terms(spark), derived.fixture_dictionaries(spark),
        _fixture_matches(spark, sf_dir, SINCE),
    )


def freshness_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.check_freshness(stored_live_counts(spark, sf_dir))


def health_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    own, dictionaries = derived.spoken_dict_terms(spark, sf_dir), derived.catalog(spark, sf_dir)
    registered = own.where(F.size("classification") > 0)
    stored = terms.register_queries(derived.no_stored_queries(spark), registered, dictionaries)
    sampled = settle(quality.sample_terms(own, by_hash=True).select("dict_id", "term"))
    return quality.health_check(
        derived.articles(spark, sf_dir), own, dictionaries, _spoken_matches(spark, sf_dir, SINCE, by_term=True),
        stored, sampled, of_sampled=_spoken_matches(spark, sf_dir, SINCE, among=sampled),
    )


QUERIES = {
    "match_no_stem": match_field(T.NO_STEM, 1),
    "match_case_sensitive_no_stem": match_field(T.CASE_SENSITIVE_NO_STEM, 2),
    "match_english": match_field(T.ENGLISH, 3),
    "match_case_sensitive": match_field(T.CASE_SENSITIVE, 4),
    "match_by_dictionary": match_by_dictionary,
    "match_hierarchy": match_hierarchy,
    "match_since": match_since,
    "catch_up": catch_up,
    "match_spoken_terms": match_spoken_terms,
    "highlight_snippets": highlight_snippets,
    "tokenize_counts": tokenize_counts,
    "analyze_english": analyze_field(T.ENGLISH),
    "analyze_case_sensitive": analyze_field(T.CASE_SENSITIVE),
    "analyze_masked": analyze_field(T.NO_STEM),
    "analyze_case_sensitive_masked": analyze_field(T.CASE_SENSITIVE_NO_STEM),
    "strip_possessive": strip_possessive,
    "list_terms": list_terms,
    "list_dicts": list_dicts,
    "list_dicts_verbose": list_dicts_verbose,
    "dict_by_name": dict_by_name,
    "dict_by_id": dict_by_id,
    "similar_dicts": similar_dicts,
    "add_dictionary": add_dictionary,
    "contents_field": contents_field,
    "csv_terms": csv_terms,
    "json_terms": json_terms,
    "terms_to_add": terms_to_add,
    "terms_to_remove": terms_to_remove,
    "pairs_to_add": pairs_to_add,
    "pairs_to_remove": pairs_to_remove,
    "ingest_terms": ingest_terms,
    "ingest_terms_anew": ingest_terms_anew,
    "update_terms": update_terms,
    "upsert_matches": upsert_matches,
    "upsert_documents": upsert_documents,
    "delete_term": delete_term,
    "remove_dictionary": remove_dictionary,
    "touch_dictionaries": touch_dictionaries,
    "match_sentences": sentence_matches,
    "match_sentences_regex": sentence_matches_regex,
    "subset_nlp": subset("nlp"),
    "subset_nlp352": subset("nlp352"),
    "subset_nlp360": subset("nlp360"),
    "overlap_all_terms": overlap_all_terms,
    "overlap_listed_terms": overlap_listed_terms,
    "subset_registry": subset_registry,
    "stored_query_ids": stored_query_ids,
    "missing_stored_queries": missing_stored_queries,
    "unregister_queries": unregister_queries,
    "percolate_batch": percolate_batch,
    "percolate_stream": percolate_stream,
    "fold_stream": fold_stream,
    "match_kept_form": match_kept_form,
    "corpus_match": corpus_match,
    "corpus_fix_freshness": corpus_fix_freshness,
    "corpus_fold": corpus_fold,
    "doc_exists": doc_exists,
    "scan_matching": scan_matching,
    "sample_terms_hash": sample_terms_hash,
    "unmatched_terms": unmatched_terms,
    "stored_live_counts": stored_live_counts,
    "freshness_summary": freshness_summary,
    "health_summary": health_summary,
}

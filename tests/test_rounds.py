"""What large jobs keep on disk and send: postings field by field, texts spread, bits read as numbers."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from termloom.functions import text as T
from termloom.operators import bounds, matching, phrase, postings, quality, terms
from termloom.plans import corpus as plans
from termloom.plans import derived, registry
from termloom.plans.corpus import Corpus
from termloom.sources import scratch

DOCS = [("a", "Oil shale in the Oil basins", dt.datetime(2020, 1, 1)), ("b", "running The shale", None), ("c", None, None), ("d", "", None)]
DOC_SCHEMA = "docid string, contents string, time timestamp"


def test_postings_of_a_field_are_shuffled_alone(spark, tmp_path, monkeypatch):
    forms = scratch.settle(phrase.analyze_documents(spark.createDataFrame(DOCS, DOC_SCHEMA), T.FIELDS, carried=["time"]))
    fields = []
    monkeypatch.setattr(postings, "write_parquet", lambda df, path, divided: fields.append(path) or scratch.write_parquet(df, path, divided))
    postings.write_postings(forms, str(tmp_path / "kept"))
    assert len(fields) == len(T.FIELDS)
    kept = spark.read.parquet(str(tmp_path / "kept"))
    whole = postings.build_postings(forms)
    assert rows(kept.select(*whole.columns)) == rows(whole) and whole.count() > 20


def test_a_corpus_writes_postings_field_by_field(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS rounds LOCATION '{tmp_path}/rounds'")
    corpus = Corpus(spark, "rounds")
    corpus.index_documents(spark.createDataFrame(DOCS, DOC_SCHEMA))
    assert len(corpus.versions.state("postings")) == len(T.FIELDS)
    whole = postings.build_postings(scratch.settle(corpus.table("analyzed")))
    assert rows(corpus.table("postings").select(*whole.columns)) == rows(whole)


def test_documents_to_index_have_a_known_size(spark, tmp_path):
    path = str(tmp_path / "docs")
    spark.createDataFrame([(7, "x", 3)], "DOCID long, contents string, version int").write.parquet(path)
    arrivals = plans._articles(spark.read.parquet(path))
    assert bounds.plan_bytes(arrivals) < bounds.UNKNOWN_BYTES
    row = arrivals.first()
    assert (row.docid, row.contents, row.time, row.version) == ("7", "x", None, 3)


@pytest.mark.parametrize("starts", [None, {T.ENGLISH: ("ru", "ba"), T.CASE_SENSITIVE: ("Ru", "ru")}])
def test_case_sensitive_stems_are_those_of_the_form_alone(spark, starts):
    text = "Running running RUNNING's basin's Basins the The THE y Ys İstanbul ΟΔΟΣ οδος ness’s a eyed Yes İ ß"
    docs = spark.createDataFrame([(1, text), (2, None), (3, "")], "docid long, contents string")
    alone = {f: phrase.analyze_documents(docs, [f], starts=starts) for f in T.FIELDS}
    both = phrase.analyze_documents(docs, T.FIELDS, starts=starts)
    assert "_english" in both._jdf.queryExecution().analyzed().toString()
    for field, form in alone.items():
        expected, found = (dict(df.select("docid", "toks").collect()) for df in (form, both.where(F.col("field") == field)))
        if starts and field in T.STEMMED:
            # Words that either form can hold are stemmed.
            expected = {k: v and [e or f for e, f in zip(v, found[k], strict=True)] for k, v in expected.items()}
        assert found == expected


def test_a_key_filter_loses_no_key_and_passes_few_others(spark):
    known = spark.range(3000).select(F.col("id").alias("a"), F.md5(F.col("id").cast("string")).alias("b"))
    asked = spark.range(300_000).select(F.col("id").alias("a"), F.md5(F.col("id").cast("string")).alias("b"))
    met = bounds.maybe_among(asked, known, ["a", "b"])
    assert known.join(met, ["a", "b"], "left_anti").isEmpty() and met.count() < 3100
    # A number of eight bytes is looked up, and no byte of it spelled for each row.
    assert dict(bounds.key_bitmaps(known, ["a"]).dtypes)["_bits"] == "array<bigint>"


def test_rows_of_some_terms_are_made_without_the_others(spark):
    docs = spark.createDataFrame([(1, "oil shale basin"), (2, "the oil"), (3, None)], "docid long, contents string")
    own = [(1, "oil", ["shale"]), (1, "oil", ["basin"]), (2, "oil", []), (1, "shale", []), (1, None, []), (2, "none", ["oil"])]
    given = spark.createDataFrame(own, "dict_id int, term string, classification array<string>")
    settings = spark.createDataFrame([(1, False, False), (2, True, True)], "dict_id int, case_sensitive boolean, word_stemming boolean")
    some = spark.createDataFrame([("oil",), ("oil",), ("none",), (None,), ("gas",)], "term string")
    when = dt.datetime(2024, 1, 1)
    whole = matching.match_terms_to_docs(given, settings, docs, when)
    found = matching.match_terms_to_docs(given, settings, docs, when, among=some)
    assert rows(found) == rows(whole.join(some.distinct(), "term", "left_semi")) and found.count() == 4


def test_health_makes_the_matches_of_the_sample_alone(spark, tmp_path, monkeypatch):
    said = ["oil shale basin", "Oil shale", "no such words as are given here", "", None]
    given = {
        "conversations": ("conv_id long, role string, text string", [(i, "user", text) for i, text in enumerate(said * 2)]),
        "documents": ("doc_id long, text string, source string", [(i + 300, t, "s") for i, t in enumerate(["oil shale", "the shale Basin"])]),
        "nation": ("n_nationkey long, n_name string", [(0, "n0")]),
        "supplier": (
            "s_suppkey long, s_name string, s_nationkey long, s_acctbal double", [(i, f"s{i}", 0, 6000.0 * (i % 3)) for i in range(10)],
        ),
    }
    for table, (schema, some) in given.items():
        spark.createDataFrame(some, schema).write.parquet(f"{tmp_path}/{table}.parquet")
    asked = []
    match = matching.match_terms_to_docs
    monkeypatch.setattr(matching, "match_terms_to_docs", lambda *a, **how: asked.append(how) or match(*a, **how))
    monkeypatch.setattr(quality, "sample_terms", lambda own, **how: own.where("term LIKE '%shale%'"))
    found = registry.health_summary(spark, str(tmp_path))
    assert [(how["by_term"], how["among"] is not None) for how in asked] == [(True, False), (False, True)]
    own, settings = derived.spoken_dict_terms(spark, str(tmp_path)), derived.catalog(spark, str(tmp_path))
    docs = derived.articles(spark, str(tmp_path))
    whole = match(own, settings, docs, registry.AS_OF, registry.SINCE)
    queries = terms.register_queries(derived.no_stored_queries(spark), own.where(F.size("classification") > 0), settings)
    plain = quality.health_check(docs, own, settings, whole, queries, own.where("term LIKE '%shale%'"))
    assert rows(found) == rows(plain) and found.agg(F.sum("n_checked")).first()[0] > 2


def test_terms_are_sent_to_larger_blocks(spark, monkeypatch):
    monkeypatch.setattr(bounds, "plan_bytes", lambda df: 400 * bounds.SPREAD_BYTES)
    assert bounds.in_blocks(spark.range(9), "id", times=4)[1] == 100 and bounds.in_blocks(spark.range(9), "id")[1] == 400
    asked = []
    monkeypatch.setattr(matching, "in_blocks", lambda df, key, times=1: asked.append(times) or bounds.in_blocks(df, key, times=100 * times))
    monkeypatch.setattr(matching, "MOST_PHRASES", 0)
    docs = spark.createDataFrame([(1, "oil shale"), (2, "oil"), (2, "shale")], "docid long, contents string")
    given = spark.createDataFrame([(1, "oil", ["shale"]), (1, "shale", [])], "dict_id int, term string, classification array<string>")
    settings = spark.createDataFrame([(1, False, True)], "dict_id int, case_sensitive boolean, word_stemming boolean")
    found = [
        rows(matching.match_terms_to_docs(given, settings, docs, broadcast_bytes=limit).select("term", "docid", "hits", "hierarchy_present"))
        for limit in (None, 0)
    ]
    assert found[0] == found[1] == [("oil", 1, 1, True), ("oil", 2, 1, True), ("shale", 1, 1, None), ("shale", 2, 1, None)]
    assert asked == [1, matching.SENT_TIMES]


def test_the_mark_of_a_part_is_the_sum_of_its_hashes(spark, tmp_path):
    versions = Corpus(spark, _database(spark, "marks", tmp_path)).versions
    docs = spark.createDataFrame([(f"d{i}", i, f"t{i}") for i in range(500)], "term string, sentid int, docid string")
    layout = "term string, docid string, sentid int"
    _, n, mark = versions._write("marks", docs, 1, layout, ())
    assert n == 500 and mark == str(sum(r[0] for r in docs.select(F.xxhash64("term", "docid", "sentid")).collect()))
    assert versions._write("marks", docs.where("false"), 1, layout, ())[1:] == (0, "0")


def _database(spark, name, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{tmp_path}/{name}'")
    return name

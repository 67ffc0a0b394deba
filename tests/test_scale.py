"""What must not grow with the input: work per word, tasks, shuffles, copies."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conftest import rows
from termloom.functions import text as T
from termloom.functions.stemmer import kept_start, stem_sql
from termloom.operators import bounds, matching, phrase, postings, quality, sentences
from termloom.plans import registry
from termloom.sources import scratch

WORDS = (
    "aing ayed ties ies dies y yes ying hoping fating ebbing ability rationally aes bus as as's erie ere erring Er ER "
    "relational organization sensibility agreed at ated ize izing 10s x's ai eyed hehely from fromage"
).split()


def test_a_stem_begins_as_its_words_do(spark):
    words = spark.createDataFrame([(WORDS,)], "words array<string>")
    stems = words.select(F.explode(F.arrays_zip("words", F.expr(stem_sql("words")).alias("stems"))).alias("w"))
    wrong = stems.select("w.words", "w.stems").where(f"NOT startswith(words, {kept_start('stems')})")
    assert wrong.collect() == []


@pytest.mark.parametrize("field", T.FIELDS)
def test_words_that_no_phrase_holds_are_not_stemmed(spark, field):
    docs = spark.createDataFrame([(1, " ".join(WORDS)), (2, "The ability of ties, eyed"), (3, None)], "docid long, contents string")
    terms = spark.createDataFrame([(t, field) for t in ("able", "ties", "Er", "ability of ties", "ayed")], "term string, field string")
    phrases = phrase.compile_terms(terms, fields=[field])
    all_words = phrase.count_phrases(phrase.analyze_documents(docs, [field]), phrases)
    some = phrase.analyze_documents(docs, [field], starts=phrases.starts)
    assert rows(phrase.count_phrases(some, phrases)) == rows(all_words)
    if field in T.STEMMED:
        assert some.where("array_contains(toks, 'sensibl')").isEmpty()


def test_large_inputs_are_spread_over_more_tasks(spark, monkeypatch):
    df = spark.range(100).select("id", F.col("id").cast("string").alias("text"))
    monkeypatch.setattr(bounds, "plan_bytes", lambda rows: 40 * bounds.SPREAD_BYTES)
    assert bounds.spread(df, "id").rdd.getNumPartitions() == 40
    monkeypatch.setattr(bounds, "plan_bytes", lambda rows: 1 << 62)
    assert bounds.spread(df, "id") is df


def test_a_task_over_texts_is_small(spark, monkeypatch):
    monkeypatch.setattr(bounds, "plan_bytes", lambda rows: 100 << 20)
    assert bounds.spread(spark.range(10), "id").rdd.getNumPartitions() >= 50


def test_postings_are_shuffled_once(spark):
    def forms(docs):
        return scratch.settle(phrase.analyze_documents(spark.createDataFrame(docs, "docid long, contents string, time timestamp"),
                                                       T.FIELDS, carried=["time"]))

    built = postings.build_postings(forms([(1, "stone the stones a stone", None), (2, "", None), (3, None, None)]))
    plan = built._jdf.queryExecution().toString().partition("== Physical Plan ==")[2]
    assert plan.count("Exchange") == 1
    found = {(r.field, r.token): r.positions for r in built.collect()}
    assert found[(T.NO_STEM, "stone")] == [0, 4] and found[(T.ENGLISH, "stone")] == [0, 2, 4]
    assert (T.NO_STEM, "the") not in found
    twice = postings.build_postings(forms([(1, "b a b", None), (1, "b c", None), (2, "b", None)]))
    places = {(r.docid, r.token): r.positions for r in twice.where(F.col("field") == T.CASE_SENSITIVE_NO_STEM).collect()}
    assert places == {(1, "b"): [0, 0, 2], (1, "c"): [1], (2, "b"): [0]}


def test_known_runs_are_looked_for_one_by_one(spark, monkeypatch):
    lines = spark.createDataFrame([(1, 1, ["an", "anea", "stone"]), (1, 2, ["ANEA"]), (2, 1, ["er"])], "docid long, sentid int, words array<string>")
    terms = spark.createDataFrame([("anea",), ("sto.e",), ("er",), ("(a|e)r",)], "term string")
    pairs = terms.crossJoin(lines.select("docid").distinct())
    none = pairs.where("false")

    def found():
        return sentences.match_sentences(lines, pairs, terms, none, regex_terms=True)

    plan = found()
    few = rows(plan)
    monkeypatch.setattr(sentences, "SPELLED_GRAMS", 0)
    assert few == rows(found()) == sorted([
        ("anea", 1, 1, "an anea stone"), ("anea", 1, 2, "ANEA"), ("er", 2, 1, "er"), ("sto.e", 1, 1, "an anea stone"), ("(a|e)r", 2, 1, "er"),
    ], key=repr)


def test_a_write_leaves_the_setting_of_the_session(spark, tmp_path):
    before = spark.conf.get(scratch.CLEANUP, None)
    scratch.write_parquet(spark.range(9).repartition(3, "id"), str(tmp_path / "rows"))
    assert spark.conf.get(scratch.CLEANUP, None) == before
    assert spark.read.parquet(str(tmp_path / "rows")).count() == 9


TEXTS = ["Oil shale in the oil basin", "the shale, an OIL basin", "oil shale oil", None, "", "basin of shale"]
TERMS = [
    (1, "oil shale", ["basin"]), (1, "the oil", ["oil"]), (1, "oil", ["shale", "basin"]), (1, "the", ["oil"]), (1, "shale", []),
    (2, "Oil shale", ["the"]), (2, "OIL", ["basin", "none"]), (2, "shale of", ["Oil"]), (1, "none", ["oil"]), (1, "shale basin", None),
]


def matches_in_blocks(spark, broadcast_bytes):
    docs = [(i % 5, text) for i, text in enumerate(TEXTS * 2)] + [(None, "oil")]
    terms = spark.createDataFrame(TERMS, "dict_id int, term string, classification array<string>")
    settings = spark.createDataFrame([(1, False, True), (2, True, False)], "dict_id int, case_sensitive boolean, word_stemming boolean")
    docs = spark.createDataFrame(docs, "docid long, contents string")
    found = matching.match_terms_to_docs(terms, settings, docs, broadcast_bytes=broadcast_bytes)
    return found.select("dict_id", "term", "docid", "hits", "hierarchy_present")


@pytest.mark.parametrize("spelled", [24, 0])
@pytest.mark.parametrize("limit", [None, 4000])
def test_matches_of_a_large_dictionary_are_not_shuffled(spark, monkeypatch, limit, spelled):
    whole = rows(matches_in_blocks(spark, None))
    assert len(whole) > 12 and {row[4] for row in whole} == {None, True, False}
    monkeypatch.setattr(matching, "MOST_PHRASES", 0)
    monkeypatch.setattr(phrase, "SPELLED_SHAPES", spelled)
    found = matches_in_blocks(spark, limit)
    plan = found._jdf.queryExecution().executedPlan().toString()
    sent = [line for line in plan.splitlines() if "Exchange" in line and "Broadcast" not in line]
    # Texts, (block, gram) and terms, but neither counts nor matches of a document.
    assert sent and not any("hits" in line or "docid" in line for line in sent)
    assert ("direct_shuffle_partition_id" in plan) and rows(found) == whole


def test_kept_forms_are_matched_in_blocks(spark, monkeypatch):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "docid long, contents string")
    terms = spark.createDataFrame(TERMS, "dict_id int, term string, classification array<string>")
    settings = spark.createDataFrame([(1, False, True), (2, True, False)], "dict_id int, case_sensitive boolean, word_stemming boolean")
    kept = scratch.settle(phrase.analyze_documents(docs, T.FIELDS))
    whole = rows(matching.match_terms_to_docs(terms, settings, docs).drop("last_updated"))
    monkeypatch.setattr(matching, "MOST_PHRASES", 0)
    for limit in (None, 4000):
        found = matching.match_terms_to_docs(terms, settings, docs, analyzed=kept, broadcast_bytes=limit)
        assert rows(found.drop("last_updated")) == whole


def test_stored_matches_of_other_terms_are_dropped_before_the_shuffle(spark):
    docs = spark.createDataFrame([(1, "oil"), (2, "oil shale")], "docid long, contents string")
    terms = spark.createDataFrame([(1, "oil"), (1, "shale"), (1, None)], "dict_id int, term string")
    settings = spark.createDataFrame([(1, False, False)], "dict_id int, case_sensitive boolean, word_stemming boolean")
    stored = spark.createDataFrame([("oil", 1), ("oil", 1), ("gas", 1), (None, 1)], "term string, docid long")
    compared = quality.compare_stored_live(docs, terms, settings, stored)
    assert "bitmap_construct_agg" in compared._jdf.queryExecution().executedPlan().toString()
    assert rows(compared) == sorted([(1, "oil", 1, 2), (1, "shale", 0, 1), (1, None, 0, 0)], key=repr)


def test_unmatched_terms_shuffle_no_matches(spark, monkeypatch):
    monkeypatch.setattr(matching, "MOST_PHRASES", 0)
    own = spark.createDataFrame(TERMS, "dict_id int, term string, classification array<string>")
    left = quality.terms_without_matches(own, matches_in_blocks(spark, 4000))
    sent = [line for line in left._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in line]
    assert not any("hits" in line or "docid" in line for line in sent if "Broadcast" not in line)
    whole = {row[1] for row in rows(matches_in_blocks(spark, None))}
    assert {row[0] for row in rows(left.select("term"))} == {row[1] for row in TERMS} - whole


@pytest.mark.parametrize("limit, shapes", [(None, 512), (0, 512), (0, 0)])
def test_matches_by_term_are_the_same_rows(spark, monkeypatch, limit, shapes):
    monkeypatch.setattr(matching, "MOST_PHRASES", 0)
    monkeypatch.setattr(phrase, "MAX_SHAPES", shapes)
    docs = spark.createDataFrame(list(enumerate(TEXTS)) + [(0, "oil"), (None, "none")], "docid long, contents string")
    terms = spark.createDataFrame(TERMS * 2, "dict_id int, term string, classification array<string>")
    settings = spark.createDataFrame([(1, False, True), (2, True, False)], "dict_id int, case_sensitive boolean, word_stemming boolean")
    kept = scratch.settle(phrase.analyze_documents(docs, T.FIELDS))
    for analyzed in (None, kept):
        whole, by_term = (
            matching.match_terms_to_docs(terms, settings, docs, analyzed=analyzed, broadcast_bytes=limit, by_term=which)
            .drop("last_updated") for which in (False, True)
        )
        assert rows(by_term) == rows(whole) and by_term.columns == whole.columns
        assert rows(by_term.select("term").distinct()) == rows(whole.select("term").distinct())


@pytest.mark.parametrize("share", [1, 2, 100])
def test_terms_found_early_are_not_looked_for_again(spark, monkeypatch, share):
    docs = spark.createDataFrame([(i, text) for i, text in enumerate(TEXTS * 3)], "docid long, contents string")
    own = [(term, T.NO_STEM, []) for term in sorted({row[1] for row in TERMS})]
    queries = spark.createDataFrame(own, "term string, field string, classification array<string>")
    phrases = matching.compile_queries(queries, ["term"], broadcast_bytes=0)
    whole = rows(matching.match_queries(docs, phrases, ["term"]).select("term").distinct())
    kept = []
    monkeypatch.setattr(matching, "FIRST_SHARE", share)
    monkeypatch.setattr(matching, "settle", lambda df: kept.append(scratch.settle(df)) or kept[-1])
    assert rows(matching.terms_that_occur(docs, phrases, ["term"])) == whole
    early, _, late = kept
    assert early.join(late, ["field", "gram"], "left_semi").count() == 0
    assert early.count() + late.count() == len(whole)


def test_matches_by_term_from_postings(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "docid long, contents string")
    terms = spark.createDataFrame(TERMS, "dict_id int, term string, classification array<string>")
    settings = spark.createDataFrame([(1, False, True), (2, True, False)], "dict_id int, case_sensitive boolean, word_stemming boolean")
    forms = phrase.analyze_documents(docs.withColumn("time", F.lit(None).cast("timestamp")), T.FIELDS, carried=["time"])
    kept = scratch.settle(postings.build_postings(forms))
    whole = rows(matching.match_terms_to_docs(terms, settings, docs).drop("last_updated"))
    assert rows(matching.match_terms_to_docs(terms, settings, docs, postings=kept, by_term=True).drop("last_updated")) == whole


def test_unmatched_terms_send_no_term_to_a_block(spark, monkeypatch, tmp_path):
    said = ["oil shale basin", "Oil shale", "no such words as are given here for some more terms", "", None]
    given = {
        "conversations": ("conv_id long, role string, text string", [(i, "user", text) for i, text in enumerate(said * 2)]),
        "documents": ("doc_id long, text string, source string", [(i + 300, text, "src1") for i, text in enumerate(TEXTS)]),
        "nation": ("n_nationkey long, n_name string", [(0, "n0")]),
        "supplier": (
            "s_suppkey long, s_name string, s_nationkey long, s_acctbal double",
            [(i, f"s{i}", 0, 6000.0 * (i % 3)) for i in range(10)],
        ),
    }
    for table, (schema, some) in given.items():
        spark.createDataFrame(some, schema).write.parquet(f"{tmp_path}/{table}.parquet")
    whole = rows(registry.unmatched_terms(spark, str(tmp_path)))
    monkeypatch.setattr(matching, "MOST_PHRASES", 0)
    monkeypatch.setattr(bounds, "BROADCAST_BYTES", 4000)
    left = registry.unmatched_terms(spark, str(tmp_path))
    plan = left._jdf.queryExecution().executedPlan().toString()
    # The terms that occur are known. No text is read again, and no term is sent to the texts.
    assert "FileScan parquet [doc_id#" not in plan and "direct_shuffle_partition_id" not in plan
    found = {"oil shale", "Oil shale"}
    terms = {" ".join(words) for text in said if text for words in zip(text.split(), text.split()[1:])}
    assert rows(left) == whole and found <= terms and not found & {term for _, term in whole}
    assert {term for _, term in whole} >= {"no such", "such words"}

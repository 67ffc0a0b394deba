from __future__ import annotations

import re
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from termloom.functions import text as T
from termloom.operators import phrase
from termloom.operators.bounds import maybe_among
from termloom.operators.matching import match_terms


def docs_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts, 1)), "docid long, contents string")


def terms_of(spark, terms):
    return spark.createDataFrame([(t,) for t in terms], "term string")


def brute_force(texts, terms):
    """Hits under the lower-case analysis without stems."""
    def tokens(text):
        return [None if w in T.STOP_WORDS else w for w in re.findall(r"\w+", text.lower())]

    out = []
    for term in terms:
        wanted = tokens(term)
        while wanted and wanted[0] is None:
            wanted.pop(0)
        while wanted and wanted[-1] is None:
            wanted.pop()
        if not wanted:
            continue
        for docid, text in enumerate(texts, 1):
            toks = tokens(text)
            hits = sum(
                all(w is None or toks[i + k] == w for k, w in enumerate(wanted))
                for i in range(len(toks) - len(wanted) + 1)
            )
            if hits:
                out.append((term, docid, hits))
    return sorted(out, key=repr)


TEXTS = [
    "orre orre orre", "attion to thanedble", "attion of thanedble, attion thanedble",
    "the end of the line", "", "of the", "Mancos Shale. Shale mancos shale", "a b c a b",
]
TERMS = [
    "orre orre", "attion of thanedble", "the", "", "the end of", "of the line", "mancos shale",
    "MANCOS SHALE", "b c a", "line end", "shale", "end of the line", "zzz",
]


@pytest.mark.parametrize("limit", [None, 0])
def test_phrases_with_and_without_broadcast(spark, limit):
    got = match_terms(docs_of(spark, TEXTS), terms_of(spark, TERMS), T.NO_STEM, broadcast_bytes=limit)
    assert rows(got) == brute_force(TEXTS, TERMS)


def test_rules(spark):
    got = {(t, d): h for t, d, h in rows(match_terms(docs_of(spark, TEXTS), terms_of(spark, TERMS), T.NO_STEM))}
    assert got["orre orre", 1] == 2  # overlaps count
    assert got["attion of thanedble", 2] == 1  # a stop word leaves a hole
    assert got["attion of thanedble", 3] == 1  # that must be filled
    assert got["the end of", 4] == 1  # outer stop words are ignored
    assert not [k for k in got if k[0] in ("the", "")]


WORDS = st.sampled_from(["a", "b", "c", "the", "of", "x"])


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    texts=st.lists(st.lists(WORDS, max_size=30).map(" ".join), min_size=1, max_size=6),
    terms=st.lists(st.lists(WORDS, min_size=1, max_size=5).map(" ".join), min_size=1, max_size=6, unique=True),
)
def test_any_text(spark, texts, terms):
    got = match_terms(docs_of(spark, texts), terms_of(spark, terms), T.NO_STEM)
    assert rows(got) == brute_force(texts, terms)


@pytest.mark.parametrize("limit", [None, 0])
def test_hot_words(spark, limit):
    """One word holds most positions and leads most phrases, one text is huge."""
    texts = ["hot " * 20000 + "cold"] + [f"hot w{i} hot hot" for i in range(200)]
    terms = ["hot", "hot hot"] + [f"hot w{i}" for i in range(200)] + ["hot cold"]
    got = match_terms(docs_of(spark, texts), terms_of(spark, terms), T.NO_STEM, broadcast_bytes=limit)
    counts = Counter({t: 0 for t in terms})
    for term, _, hits in rows(got):
        counts[term] += hits
    assert counts["hot"] == 20000 + 600 and counts["hot hot"] == 19999 + 200 and counts["hot cold"] == 1
    assert all(counts[f"hot w{i}"] == 1 for i in range(200))


def test_stemmed_stop_words_do_not_match(spark):
    # "ons" has the stem "on", which a document drops as a stop word.
    got = match_terms(docs_of(spark, ["on and on", "ons"]), terms_of(spark, ["ons"]), T.ENGLISH)
    assert rows(got) == [("ons", 2, 1)]


def test_missing_texts(spark):
    docs = spark.createDataFrame([(1, None), (None, "x"), (3, "x")], "docid long, contents string")
    assert rows(match_terms(docs, terms_of(spark, ["x"]), T.NO_STEM)) == [("x", 3, 1)]
    assert rows(match_terms(docs, terms_of(spark, ["the"]), T.NO_STEM)) == []


@pytest.mark.parametrize("context, snippets", [
    (0, [("attion of thanedble", 1, 3, "Attion to Thanedble")]),
    (1, [("attion of thanedble", 1, 3, "two Attion to Thanedble four")]),
    (9, [("attion of thanedble", 1, 3, "one two Attion to Thanedble four")]),
])
def test_snippets(spark, context, snippets):
    docs = docs_of(spark, ["one two. Attion to Thanedble four"])
    terms = terms_of(spark, ["attion of thanedble"])
    assert rows(phrase.highlight_snippets(docs, terms, T.NO_STEM, context)) == snippets


def test_analyzed_table_can_be_kept(spark, tmp_path):
    docs = docs_of(spark, TEXTS)
    path = str(tmp_path / "analyzed")
    phrase.analyze_documents(docs, T.FIELDS).write.partitionBy("field").parquet(path)
    phrases = phrase.compile_terms(
        terms_of(spark, TERMS).selectExpr("term", f"'{T.NO_STEM}' AS field")
    )
    counts = phrase.count_phrases(spark.read.parquet(path), phrases)
    got = phrase.attach_terms(counts, phrases.rows.select("field", "gram", "term"), phrases)
    assert rows(got.select("term", "docid", "hits")) == brute_force(TEXTS, TERMS)


@pytest.fixture
def no_automatic_broadcast(spark):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


@pytest.mark.parametrize("max_shapes", [512, 0])
def test_beyond_broadcast_size(spark, no_automatic_broadcast, monkeypatch, max_shapes):
    monkeypatch.setattr(phrase, "MAX_SHAPES", max_shapes)
    docs = spark.createDataFrame(
        [(1, "mancos shale mancos oil"), (2, "shale of the mancos shale"), (3, None), (4, "")], "docid long, contents string"
    )
    listed = spark.createDataFrame([("mancos shale",), ("shale of the mancos",), ("oil",)], "term string")
    listed = listed.withColumn("field", F.lit(T.NO_STEM))
    counts = []
    for limit in (None, 0):
        phrases = phrase.compile_terms(listed, fields=[T.NO_STEM], broadcast_bytes=limit)
        counts.append(phrase.count_phrases(phrase.analyze_documents(docs, [T.NO_STEM]), phrases))
    assert len(rows(counts[0])) == 4 and rows(counts[0]) == rows(counts[1])
    plan = counts[1]._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan
    if max_shapes:  # no words leave the task that read them
        sent = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
        assert sent and not any("toks" in line or "words" in line for line in sent)


def test_a_key_filter_loses_no_key(spark):
    known = spark.range(0, 60000, 3).withColumn("name", F.concat(F.lit("k"), F.col("id")))
    every = spark.range(60000).withColumn("name", F.concat(F.lit("k"), F.col("id")))
    kept = maybe_among(every, known, ["id", "name"])
    assert kept.join(known, "id", "left_semi").count() == 20000
    assert kept.count() < 20100

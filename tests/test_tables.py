"""Catalog, terms, keyed changes, subsets."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from conftest import rows
from termloom import schemas
from termloom.operators import catalog, subsets, terms, upsert
from termloom.operators.terms import Tables
from termloom.sources.tables import corpus_name, doc_exists, scan_matching

AS_OF = dt.datetime(2024, 1, 1)
OLD = dt.datetime(2020, 1, 1)


def catalog_of(spark, *entries):
    data = [
        (i, name, f"{name}.csv", None, None, base, None, False, False, None, when, None)
        for i, name, base, when in entries
    ]
    return spark.createDataFrame(data, schemas.DICTIONARIES)


@pytest.fixture
def tables(spark):
    pairs = [(1, "a", []), (1, "b", ["x"]), (1, "b", ["y"]), (1, "c", []), (2, "a", []), (2, "d", [])]
    dict_terms = spark.createDataFrame([(*p, OLD) for p in pairs], schemas.DICT_TERMS)
    dictionaries = catalog_of(spark, (1, "rocks", "r", OLD), (2, "fossils", "f", OLD))
    matches = [(t, "d1", 1, OLD, None, i, False) for i, t, _ in pairs if t != "c"]
    stored = terms.register_queries(spark.createDataFrame([], schemas.STORED_QUERIES), dict_terms, dictionaries)
    return Tables(
        dictionaries=dictionaries,
        dict_terms=dict_terms,
        terms_docs=spark.createDataFrame(matches, schemas.TERMS_DOCS).distinct(),
        terms_docs_sentences=spark.createDataFrame(
            [(t, "d1", 1, "s") for t in "abcd"], schemas.TERMS_DOCS_SENTENCES
        ),
        stored_queries=stored,
        subset_meta=spark.createDataFrame(
            [(1, "rocks_nlp"), (1, "mine"), (2, "rocks_nlp")], schemas.SUBSET_META
        ),
    )


def pairs_of(df, dict_id=1):
    return rows(df.where(F.col("dict_id") == dict_id).select("term", "classification"))


# Catalog


def test_lookups(spark):
    d = catalog_of(spark, (1, "my_dict", "r", OLD), (2, "myxdict", "s", AS_OF), (3, "other", "t", None))
    assert rows(catalog.dict_by_name_ci(d, "MY_DICT").select("dict_id")) == [(1,)]
    assert catalog.resolve(d, "MYXDICT") == (2, "myxdict")
    with pytest.raises(ValueError):
        catalog.resolve(d, "none")
    assert rows(catalog.get_dictionary_metadata(d, "MY_DICT")) == []
    assert catalog.get_dictionary_metadata(d, "my_dict").columns == catalog.METADATA
    assert rows(catalog.get_dictionary_metadata_by_id(d, 3).select("name")) == [("other",)]
    assert [r.dict_id for r in catalog.list_dicts(d).collect()] == [3, 2, 1]  # unknown dates first
    assert [r.dict_id for r in catalog.list_dicts(d, verbose=True).collect()] == [1, 2, 3]


def test_add_dictionary(spark):
    d = catalog_of(spark, (1, "rocks", "geology", OLD))
    row = {"dict_id": 2, "name": "ROCK", "source": "x", "base_classification": "zoo"}
    with pytest.raises(ValueError, match="exists"):
        catalog.add_dictionary(d, {**row, "name": "Rocks"})
    with pytest.raises(ValueError, match="source"):
        catalog.add_dictionary(d, {"dict_id": 2, "name": "n", "base_classification": "b"})
    added = catalog.add_dictionary(d, {**row, "word_stemming": True}, force=True)
    assert rows(added.where("dict_id = 2").select("name", "word_stemming", "key")) == [("ROCK", True, None)]
    assert catalog.add_dictionary(d, {**row, "name": "fish"}).count() == 2


def test_list_terms_keeps_repeats(tables):
    got = catalog.list_terms(tables.dictionaries, tables.dict_terms, "ROCKS")
    assert rows(got) == [("a",), ("b",), ("b",), ("c",)]


# Terms


def source(spark, *pairs):
    return spark.createDataFrame(list(pairs), "term string, classification array<string>")


def test_ingest(spark, tables):
    new = terms.ingest(tables, 1, source(spark, (" a ", ["z"]), ("e", []), ("e", ["q"]), ("e", []), ("", [])), as_of=AS_OF)
    # A known term keeps what it has; every row of a lost term goes.
    assert pairs_of(new.dict_terms) == sorted([("a", ()), ("e", ("q",)), ("e", ())], key=repr)
    assert pairs_of(new.dict_terms, 2) == [("a", ()), ("d", ())]
    assert rows(new.terms_docs.select("dict_id", "term")) == [(1, "a"), (2, "a"), (2, "d")]
    # Nobody else holds b and c.
    assert rows(new.terms_docs_sentences.select("term")) == [("a",), ("d",)]
    assert rows(new.stored_queries.select("id", "classification")) == [
        ("1_a", ()), ("1_e", ()), ("2_a", ()), ("2_d", ())
    ]
    assert rows(new.dictionaries.select("dict_id", "last_updated")) == [(1, AS_OF), (2, OLD)]


def test_ingest_update_adds_all_anew(spark, tables):
    new = terms.ingest(tables, 1, source(spark, ("a", ["z"])), update=True, as_of=AS_OF)
    assert rows(new.dict_terms.where("dict_id = 1")) == [(1, "a", ("z",), AS_OF)]
    assert rows(new.terms_docs.select("dict_id", "term")) == [(2, "a"), (2, "d")]
    assert rows(new.terms_docs_sentences.select("term")) == [("a",), ("d",)]  # dictionary 2 holds a
    assert ("1_a", ("z",)) in rows(new.stored_queries.select("id", "classification"))


def test_update(spark, tables):
    new = terms.update(tables, 1, source(spark, ("a", []), ("b", ["y"]), ("e", ["q"])), as_of=AS_OF)
    assert pairs_of(new.dict_terms) == [("a", ()), ("b", ("y",)), ("e", ("q",))]
    # b lost a pair, hence its matches; its stored query is made from what stays.
    assert rows(new.terms_docs.select("dict_id", "term")) == [(1, "a"), (2, "a"), (2, "d")]
    assert rows(new.stored_queries.where("dict_id = 1").select("id", "classification")) == [
        ("1_a", ()), ("1_b", ("y",)), ("1_e", ("q",))
    ]


def test_differences(spark):
    old, new = source(spark, ("a", []), ("b", ["x"])), source(spark, ("b", ["y"]), ("c", []))
    assert rows(terms.terms_to_remove(old, new)) == [("a",)]
    assert rows(terms.terms_to_add(old, new)) == [("c",)]
    assert rows(terms.pairs_to_remove(old, new)) == [("a", ()), ("b", ("x",))]
    assert rows(terms.pairs_to_add(old, new)) == [("b", ("y",)), ("c", ())]


def test_delete_one_classification(spark, tables):
    doomed = spark.createDataFrame([(1, "b", ["x"])], "dict_id int, term string, classification array<string>")
    new = terms.delete_terms(tables, doomed)
    assert pairs_of(new.dict_terms) == [("a", ()), ("b", ("y",)), ("c", ())]
    assert "b" not in {t for t, in rows(new.terms_docs.select("term"))}


def test_delete_keeps_sentences_of_shared_terms(spark, tables):
    def delete(*pairs):
        doomed = spark.createDataFrame([(*p, []) for p in pairs], "dict_id int, term string, classification array<string>")
        return rows(terms.delete_terms(tables, doomed).terms_docs_sentences.select("term"))

    assert ("a",) in delete((1, "a"))
    assert ("a",) not in delete((1, "a"), (2, "a"))


def test_remove_dictionary(tables):
    new = terms.remove_dictionary(tables, "Rocks")
    assert rows(new.dictionaries.select("dict_id")) == [(2,)]
    assert rows(new.dict_terms.select("term")) == [("a",), ("d",)]
    assert rows(new.terms_docs_sentences.select("term")) == [("a",), ("d",)]
    assert rows(new.stored_queries.select("id")) == [("2_a",), ("2_d",)]
    assert rows(new.subset_meta) == [(1, "mine"), (2, "rocks_nlp")]
    with pytest.raises(ValueError):
        terms.remove_dictionary(tables, "none")


def test_stored_queries(spark, tables):
    stored = tables.stored_queries
    assert rows(stored.where("term = 'b'").select("classification")) == [(("x",),)]  # the smallest
    again = terms.register_queries(stored, tables.dict_terms, tables.dictionaries)
    assert rows(again) == rows(stored)
    slash = spark.createDataFrame([(1, "er/ha", [], None)], schemas.DICT_TERMS)
    assert rows(terms.register_queries(stored, slash, tables.dictionaries).where("term = 'er/ha'").select("id")) == [("1_er|ha",)]
    assert rows(terms.missing_queries(stored, slash.unionByName(tables.dict_terms))) == [(1, "er/ha")]
    assert rows(terms.unregister_dictionary(stored, tables.dictionaries, "rocks").select("id")) == [("2_a",), ("2_d",)]


# Keyed changes


def matches(spark, *entries):
    data = [(t, d, h, when, flag, i, False) for i, t, d, h, when, flag in entries]
    return spark.createDataFrame(data, schemas.TERMS_DOCS)


def test_upsert_last_write_wins(spark):
    target = matches(spark, (1, "a", "d1", 1, OLD, None), (1, "b", "d1", 1, OLD, True))
    updates = matches(
        spark, (1, "a", "d1", 5, AS_OF, False), (1, "a", "d1", 4, OLD, True), (2, "a", "d1", 7, OLD, None)
    )
    once = upsert.upsert_terms_docs(target, updates)
    assert rows(once.select("dict_id", "term", "hits", "hierarchy_present")) == [
        (1, "a", 5, False), (1, "b", 1, True), (2, "a", 7, None)
    ]
    assert rows(upsert.upsert_terms_docs(once, updates)) == rows(once)
    assert once.columns == target.columns


def test_upsert_without_dictionary_always_inserts(spark):
    target = matches(spark, (None, "a", "d1", 1, OLD, None))
    updates = matches(spark, (None, "a", "d1", 2, OLD, None), (None, "a", "d1", 3, OLD, None))
    assert rows(upsert.upsert_terms_docs(target, updates).select("hits")) == [(1,), (2,), (3,)]


def test_upsert_documents(spark):
    docs = spark.createDataFrame([("a", "old"), ("b", "b")], "docid string, contents string")
    new = spark.createDataFrame([("a", "new"), ("c", "c")], "docid string, contents string")
    assert rows(upsert.upsert_documents(docs, new)) == [("a", "new"), ("b", "b"), ("c", "c")]


# Subsets, lookups


def test_register_subset(spark):
    meta = spark.createDataFrame([(1, "s"), (2, "s"), (1, "t")], schemas.SUBSET_META)
    assert rows(subsets.register_subset(meta, 1, "s")) == [(1, "s"), (1, "t"), (2, "s")]
    assert rows(subsets.register_subset(meta, 0, "s")) == [(0, "s"), (1, "t")]


def test_build_and_drop_subsets(spark, tables):
    data = [(d, s, ["w"], v) for d in ("d1", "d2") for s in (2, 1) for v in schemas.NLP_TYPES]
    sentences = spark.createDataFrame(data, schemas.SENTENCES)
    for _ in range(2):  # again replaces
        meta = subsets.build_subsets(
            sentences, tables.terms_docs, tables.dict_terms, tables.dictionaries, tables.subset_meta, "fossils"
        )
    assert rows(spark.table("fossils_nlp352")) == [("d1", 1), ("d1", 2)]
    assert (2, "fossils_nlp360") in rows(meta)
    one, two = (subsets.term_set(spark, tables.dictionaries, tables.dict_terms, n) for n in ("rocks", "fossils"))
    meta = subsets.build_overlap(sentences, tables.terms_docs, one, two, meta, "both")
    assert rows(spark.table("both_nlp")) == [("d1", 1), ("d1", 2)] and (0, "both_nlp") in rows(meta)
    none = subsets.term_set(spark, tables.dictionaries, tables.dict_terms, "rocks", ["zzz"])
    assert rows(subsets.overlap(sentences, tables.terms_docs, none, two)) == []
    for name in ("fossils", "both"):
        subsets.drop_subset(spark, name)
    assert not spark.catalog.tableExists("fossils_nlp")


def test_lookups_of_documents(spark):
    docs = spark.createDataFrame([("a",), ("b",), ("c",)], "docid string")
    wanted = spark.createDataFrame([("b",), ("z",)], "docid string")
    assert rows(doc_exists(wanted, docs)) == [("b", True), ("z", False)]
    assert rows(scan_matching(docs, F.col("docid") > "a")) == [("b",), ("c",)]
    assert rows(scan_matching(docs, F.col("docid") > "a", 1)) == [("b",)]
    assert corpus_name("public", "t") == corpus_name(None, "t") == "t" and corpus_name("x", "t") == "x.t"


def test_a_stored_query_stays_while_a_classification_does(spark, tables):
    entries = [(1, "x", ["a"], None), (1, "x", ["b"], None), (1, "y", ["a"], None)]
    own = spark.createDataFrame(entries, schemas.DICT_TERMS)
    stored = terms.register_queries(tables.stored_queries.limit(0), own, tables.dictionaries)
    before = replace(tables, dict_terms=own, stored_queries=stored)
    doomed = spark.createDataFrame([(1, "x", ["b"]), (1, "y", ["a"])], "dict_id int, term string, classification array<string>")
    after = terms.delete_terms(before, doomed)
    assert rows(after.stored_queries.select("id", "classification")) == [("1_x", ("a",))]


@pytest.mark.parametrize("change", [terms.ingest, terms.update])
def test_padded_stored_terms_leave(spark, tables, change):
    own = spark.createDataFrame([(1, " x", [], None), (1, "\tz", [], None)], schemas.DICT_TERMS)
    incoming = spark.createDataFrame([("y", []), ("z", [])], "term string, classification array<string>")
    after = change(replace(tables, dict_terms=own), 1, incoming)
    assert rows(after.dict_terms.select("term")) == [("\tz",), ("y",)]

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from conftest import rows
from termloom import schemas
from termloom.functions import text as T
from termloom.operators import phrase
from termloom.operators.matching import catch_up, instant, match_terms_to_docs
from termloom.plans import derived

AS_OF = dt.datetime(2024, 1, 1)
SF = "/root/testdata/sf0.001"


def dictionaries(spark):
    return derived.fixture_dictionaries(spark)


def terms(spark, entries):
    return spark.createDataFrame([(*e, None) for e in entries], schemas.DICT_TERMS)


def docs(spark, texts, days=None):
    days = days or [1] * len(texts)
    data = [(i, t, dt.datetime(2020, 1, d, 12)) for i, (t, d) in enumerate(zip(texts, days), 1)]
    return spark.createDataFrame(data, "docid long, contents string, time timestamp")


def flags(df):
    return {(r.dict_id, r.term, r.docid): (r.hits, r.hierarchy_present) for r in df.collect()}


@pytest.mark.parametrize("limit", [None, 0])
def test_hierarchy(spark, limit):
    entries = [
        (1, "shale", []), (1, "slate", ["rock", "the"]), (1, "marl", ["marl"]), (1, "chert", ["the"]),
        (1, "tuff", ["tuff", "ash fall"]),
    ]
    texts = ["shale slate slate rock", "slate marl chert", "tuff and ash fall", "tuff ash"]
    got = flags(match_terms_to_docs(
        terms(spark, entries), dictionaries(spark), docs(spark, texts), AS_OF, broadcast_bytes=limit
    ))
    assert got == {
        (1, "shale", 1): (1, None),
        (1, "slate", 1): (2, True),  # hits do not depend on the hierarchy
        (1, "slate", 2): (1, False),
        (1, "marl", 2): (1, True),  # nothing but the term itself is asked for
        (1, "chert", 2): (1, False),  # an entry of stop words matches nothing
        (1, "tuff", 3): (1, True),
        (1, "tuff", 4): (1, False),
    }


def test_each_dictionary_has_its_analyser(spark):
    entries = [(i, "Running", []) for i in (1, 2, 3, 4)]
    texts = ["running", "Running", "run", "Run", "RUNNING"]
    got = match_terms_to_docs(terms(spark, entries), dictionaries(spark), docs(spark, texts), AS_OF)
    found = {i: [d for k, d in rows(got.select("dict_id", "docid")) if k == i] for i in (1, 2, 3, 4)}
    assert found == {1: [1, 2, 5], 2: [2], 3: [1, 2, 3, 4, 5], 4: [2, 4]}


def test_from_date_drops_the_time_of_day(spark):
    got = match_terms_to_docs(
        terms(spark, [(1, "x", [])]), dictionaries(spark), docs(spark, ["x"] * 3, [1, 2, 3]), AS_OF,
        from_date=dt.datetime(2020, 1, 2, 23),
    )
    assert rows(got.select("docid")) == [(2,), (3,)]


def test_one_row_per_term_and_document(spark):
    entries = [(1, "x", ["a"]), (1, "x", ["b"]), (1, "x", [])]
    got = match_terms_to_docs(terms(spark, entries), dictionaries(spark), docs(spark, ["x b"]), AS_OF)
    assert flags(got) == {(1, "x", 1): (1, True)}
    row = got.first()
    assert row.from_percolation is False and row.last_updated == AS_OF


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("Initial Plan")[0]


@pytest.mark.parametrize("spread", [True, False])
def test_text_is_read_and_tokenized_once(spark, monkeypatch, spread):
    if not spread:
        from termloom.operators import bounds

        monkeypatch.setattr(bounds, "SPREAD_BYTES", 0)
    df = match_terms_to_docs(
        derived.fixture_terms(spark), dictionaries(spark), derived.articles(spark, SF), AS_OF
    )
    plan = final_plan(df)
    assert plan.count("posexplode(toks") == 1
    assert plan.count("documents.parquet") == 1
    scans = re.findall(r"documents.parquet.*?ReadSchema: struct<([^>]*)>", plan)
    assert scans == ["doc_id:bigint,text:string"]
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    if not spread:
        assert "REPARTITION_BY_NUM" not in plan


def test_text_is_not_shuffled_beyond_broadcast_size_of_input(spark, monkeypatch):
    from termloom.operators import bounds

    monkeypatch.setattr(bounds, "SPREAD_BYTES", 0)
    df = match_terms_to_docs(
        derived.fixture_terms(spark), dictionaries(spark), derived.articles(spark, SF), AS_OF
    )
    for line in final_plan(df).splitlines():
        if "Exchange hashpartitioning" in line:
            assert "_text" not in line and "toks" not in line


def test_date_filter_is_pushed_to_the_scan(spark, tmp_path):
    path = str(tmp_path / "docs")
    docs(spark, ["x"] * 3, [1, 2, 3]).write.parquet(path)
    df = match_terms_to_docs(
        terms(spark, [(1, "x", [])]), dictionaries(spark), spark.read.parquet(path), AS_OF,
        from_date=dt.datetime(2020, 1, 2),
    )
    assert re.search(r"PushedFilters: \[[^]]*GreaterThanOrEqual\(time", final_plan(df))


def test_catch_up_takes_each_term_from_its_own_day(spark):
    entries = [(1, "x", [], dt.datetime(2020, 1, 2, 23)), (1, "y", [], dt.datetime(2020, 1, 3, 1)), (1, "z", [], None)]
    own = spark.createDataFrame(entries, schemas.DICT_TERMS)
    days = docs(spark, ["x y z"] * 3, [1, 2, 3])
    got = catch_up(own, dictionaries(spark), days, AS_OF)
    assert rows(got.select("term", "docid")) == [("x", 2), ("x", 3), ("y", 3), ("z", 1), ("z", 2), ("z", 3)]
    dated = catch_up(own.where("term <> 'z'"), dictionaries(spark), days, AS_OF)
    assert rows(dated.select("term", "docid")) == [("x", 2), ("x", 3), ("y", 3)]


def test_literal_times_are_in_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        shown = spark.range(1).select(instant(AS_OF).cast("string"), instant(AS_OF.date()).cast("string")).first()
        zoned = spark.range(1).select(instant(AS_OF.replace(tzinfo=dt.timezone.utc)).cast("string")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert tuple(shown) == ("2024-01-01 00:00:00",) * 2
    assert zoned[0] == "2023-12-31 19:00:00"


def test_kept_forms_honour_the_date(spark):
    day = dt.datetime(2020, 6, 1, 8)
    docs = spark.createDataFrame(
        [("a", "shale", dt.datetime(2019, 1, 1)), ("b", "shale", day), ("c", "shale", None)],
        "docid string, contents string, time timestamp",
    )
    dict_terms = spark.createDataFrame([(1, "shale", [], None)], schemas.DICT_TERMS)
    dictionaries = derived.fixture_dictionaries(spark)
    kept = phrase.analyze_documents(docs, [T.NO_STEM], carried=["time"]).cache()

    def docids(**how):
        return [r[0] for r in rows(match_terms_to_docs(dict_terms, dictionaries, docs, **how).select("docid"))]

    assert docids(from_date=day) == docids(from_date=day, analyzed=kept) == ["b"]
    assert docids(analyzed=kept) == ["a", "b", "c"]
    with pytest.raises(ValueError, match="lack"):
        docids(analyzed=kept.withColumn("field", F.lit(T.ENGLISH)))

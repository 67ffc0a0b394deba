"""Hot keys are split by adaptive execution wherever they are joined by shuffle."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from termloom.operators import sentences, subsets, upsert

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
}


@pytest.fixture
def small_partitions(spark):
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield
    for key in SETTINGS:
        spark.conf.unset(key)


@pytest.fixture
def lines(spark, tmp_path):
    """Half of all sentences belong to one document."""
    path = str(tmp_path / "lines")
    rows = spark.range(0, 60000, 1, 6).select(
        F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id")).alias("docid"),
        F.col("id").cast("int").alias("sentid"),
        F.array(F.lit("shale"), F.md5(F.col("id").cast("string"))).alias("words"),
    )
    rows.write.parquet(path)
    return spark.read.parquet(path)


def final_plan(df, action):
    action(df)
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def known(spark):
    return spark.range(60000).select(F.lit("shale").alias("term"), F.col("id").alias("docid"), F.lit(1).alias("dict_id"))


def test_subset_splits_a_hot_document(spark, small_partitions, lines):
    own = spark.createDataFrame([("shale",)], "term string")
    df = subsets.subset(lines, known(spark), own, 1)
    plan = final_plan(df, lambda d: d.collect())
    assert "skew=true" in plan
    assert df.count() == 60000


@pytest.fixture
def one_plan(monkeypatch):
    """What is found is not written in between, so that one plan shows all joins."""
    monkeypatch.setattr(sentences, "settle", lambda rows: rows)


# Sentences with "shal" and a term with it; the second has no characters that it needs.
@pytest.mark.parametrize("term", ["sha+le", "(sha)+le"])
def test_regex_sentences_split_a_hot_document(spark, small_partitions, lines, one_plan, term):
    own = spark.createDataFrame([(term,)], "term string")
    pairs = known(spark).withColumn("term", F.lit(term))
    df = sentences.match_sentences(lines, pairs, own, pairs.limit(0), regex_terms=True)
    assert "skew=true" in final_plan(df, lambda d: d.collect())
    assert df.count() == 60000


def test_literal_sentences_reduce_a_hot_term(spark, small_partitions, lines, one_plan):
    own = spark.createDataFrame([("shale",)], "term string")
    df = sentences.match_sentences(lines, known(spark), own, known(spark).limit(0))
    assert "skew=true" in final_plan(df, lambda d: d.collect())
    assert df.count() == 60000


def test_deleting_splits_a_hot_key(spark, small_partitions, lines):
    doomed = spark.range(0, 60000, 2).select(F.col("id").alias("docid"))
    df = upsert.delete_rows(lines, doomed, ["docid"])
    assert "skew=true" in final_plan(df, lambda d: d.collect())
    assert df.where("docid = 7").count() == 30001  # and the document that is 7 itself


def test_last_write_of_a_hot_key_is_reduced_before_the_shuffle(spark, lines):
    updates = lines.select("docid", "sentid", F.lit("x").alias("value"))
    df = upsert.last_write_wins(updates, ["docid"], ["sentid"])
    plan = final_plan(df, lambda d: d.collect())
    assert "partial_max" in plan and "Window" not in plan
    assert df.where("docid = 7").first().sentid == 59998

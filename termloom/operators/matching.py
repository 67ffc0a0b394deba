"""Matching terms to documents, with and without their hierarchy."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.functions import text as T
from termloom.operators import phrase
from termloom.operators.bounds import in_blocks, key_bitmaps
from termloom.operators.postings import MOST_PHRASES, count_by_postings
from termloom.sources.scratch import settle

# Blocks that terms are sent to are so many times larger than others: each needs the frequent terms anew.
SENT_TIMES = 4

# Terms are looked for in one of so many documents before they are looked for in all others.
FIRST_SHARE = 8


def instant(value: dt.datetime | dt.date) -> Column:
    """A literal timestamp; without a zone of its own it is in the session's."""
    if getattr(value, "tzinfo", None) is not None:
        return F.lit(value).cast("timestamp")
    return F.lit(value.isoformat()).cast("timestamp")


def since(from_date: dt.datetime | dt.date, time: str = "time") -> Column:
    """On or after the day of ``from_date``; its time of day is dropped."""
    return F.col(time) >= F.date_trunc("day", instant(from_date))


def match_terms(
    docs: DataFrame, terms: DataFrame, field: str = T.ENGLISH, broadcast_bytes: int | None = None
) -> DataFrame:
    """(term, docid, hits) for a plain list of terms."""
    phrases = phrase.compile_terms(
        terms.select("term", F.lit(field).alias("field")), fields=[field], broadcast_bytes=broadcast_bytes
    )
    counts = phrase.count_phrases(phrase.analyze_documents(docs, [field], starts=phrases.starts), phrases)
    rows = phrase.attach_terms(counts, phrases.rows.select("field", "gram", "term"), phrases)
    return rows.select("term", "docid", "hits")


def with_field(dict_terms: DataFrame, dictionaries: DataFrame) -> DataFrame:
    """Add the analysed form that each term's dictionary asks for."""
    settings = dictionaries.select(
        "dict_id", T.contents_field(F.col("case_sensitive"), F.col("word_stemming")).alias("field")
    )
    return dict_terms.join(settings, "dict_id")


def compile_queries(
    queries: DataFrame, keys: Sequence[str] = ("dict_id", "term"), broadcast_bytes: int | None = None
) -> phrase.Phrases:
    """Compile the terms and the classification entries of ``queries`` together.

    ``queries`` holds ``keys``, ``classification`` and ``field``, one row per
    ``keys``, ``term`` among them.
    """
    given = F.coalesce("classification", F.array().cast("array<string>"))
    queries = queries.withColumn("classification", given)
    spelled = F.array_distinct(F.concat(F.array("term"), "classification"))
    entries = queries.select(*keys, "classification", "field", F.explode(spelled).alias("entry"))
    return phrase.compile_terms(entries, "entry", broadcast_bytes=broadcast_bytes)


def _needed_forms(analyzed: DataFrame, phrases: phrase.Phrases) -> DataFrame:
    """The kept forms that ``phrases`` are compiled for; all must be there."""
    # There are four forms at most.
    forms = {row["field"] for row in analyzed.select("field").distinct().collect()}
    if forms and not forms.issuperset(phrases.fields):
        raise ValueError(f"analyzed documents lack {sorted(set(phrases.fields) - forms)}")
    return analyzed.where(F.col("field").isin(phrases.fields))


def _read_counts(docs: DataFrame, phrases: phrase.Phrases, analyzed: DataFrame | None) -> DataFrame:
    """The counts of all phrases by reading every document, or its kept forms."""
    if analyzed is not None:
        analyzed = _needed_forms(analyzed, phrases)
    else:
        analyzed = phrase.analyze_documents(docs, phrases.fields or [T.ENGLISH], reused=True, starts=phrases.starts)
    # The test is always true. It keeps the count in all three readers of the
    # counts, so that their shuffles are the same and the text is read once.
    return phrase.count_phrases(analyzed, phrases).where(F.col("hits") > 0)


def _match_in_blocks(
    docs: DataFrame, phrases: phrase.Phrases, terms: DataFrame, keys: Sequence[str], analyzed: DataFrame | None
) -> DataFrame:
    """``match_queries`` for a large dictionary, whose matches are many times the texts.

    They are not shuffled. Documents are dealt to blocks once; the terms are broadcast, or
    those that a block's documents may hold are sent to the block, and counts, matches and
    flags are made there.
    """
    if analyzed is None:
        dealt = docs.select("docid", "contents").where(F.col("docid").isNotNull())
    else:
        dealt = _needed_forms(analyzed, phrases).select("docid", "field", "toks")
    dealt, blocks = in_blocks(dealt, "docid", times=1 if phrases.small else SENT_TIMES)
    ids = ["_block", "docid"]
    if analyzed is None:
        dealt = phrase.analyze_documents(dealt, phrases.fields, ["docid"], carried=["_block"], placed=True)

    is_term = F.col("entry") == F.col("term")
    own, rest = phrases.rows.where(is_term), phrases.rows.where(~is_term)
    if phrases.small:
        found = phrase.find_phrases(dealt, replace(phrases, rows=own), ids)
        others = phrase.find_phrases(dealt, replace(phrases, rows=rest), ids)
    else:
        found = phrase.find_candidates(dealt, phrase.wanted(own), ids)
        others = phrase.find_candidates(dealt, phrase.wanted(rest), ids)

    counts = found.groupBy(*ids, "field", "gram").agg(F.count("*").cast("int").alias("hits"))
    if phrases.small:
        matched = phrase.attach_terms(counts, terms, phrases)
    else:
        here = found.select("_block", "field", "gram").distinct()
        sent = here.join(terms, ["field", "gram"]).repartitionById(blocks, F.col("_block"))
        matched = counts.join(sent, ["_block", "field", "gram"])
    matched = matched.drop("gram")
    # At most a row for each word of a block: hashed, so that the matches are not sorted.
    present = others.select(*ids, "field", "gram").distinct().withColumn("here", F.lit(True)).hint("shuffle_hash")
    row = ["docid", *keys, "classification", "hits"]
    one = matched.withColumn("gram", F.get("others", F.lit(0))).where(F.coalesce(F.size("others"), F.lit(0)) < 2)
    one = one.join(present, [*ids, "field", "gram"], "left").withColumn("here", F.col("here").isNotNull())
    # Where no classification has several entries Spark finds nothing to join here and leaves it out.
    more = matched.where(F.size("others") > 1).withColumn("gram", F.explode("others"))
    more = more.join(present, [*ids, "field", "gram"], "left").groupBy(*ids, *keys, "classification", "lone").agg(
        F.max("hits").alias("hits"), (F.count("here") > 0).alias("here")
    )
    flag = F.when(F.size("classification") > 0, F.col("lone") | F.col("here")).alias("hierarchy_present")
    return one.select(*row, flag).unionByName(more.select(*row, flag))


def match_queries(
    docs: DataFrame,
    phrases: phrase.Phrases,
    keys: Sequence[str] = ("dict_id", "term"),
    analyzed: DataFrame | None = None,
    postings: DataFrame | None = None,
) -> DataFrame:
    """(docid, keys, classification, hits, hierarchy_present) for every match.

    The flag is null without a classification, true when the document also holds
    another entry of it (or when there is no entry but the term itself), else
    false.

    Terms and classification entries are counted in the same pass. The counts are
    then looked up once more, by document and gram, for the entries of matched
    terms only, so an entry shared by many terms costs nothing where its term
    does not occur.

    With ``postings`` a dictionary of moderate size is looked up in them and no text is
    read; a larger one is matched as if they were not there, block by block of the documents.
    """
    keys = list(keys)
    is_term = F.col("entry") == F.col("term")
    lone = F.forall("classification", lambda entry: entry == F.col("term"))
    other_grams = phrases.rows.where(~is_term).groupBy(*keys).agg(F.collect_set("gram").alias("others"))
    terms = (
        phrases.rows.where(is_term)
        .select(*keys, "classification", "field", "gram", lone.alias("lone"))
        .join(other_grams, keys, "left")
    )

    if postings is not None and phrases.number <= MOST_PHRASES:
        # Only what matched, and read up to three times.
        counts = settle(count_by_postings(postings, phrases))
    elif phrases.number > MOST_PHRASES and (phrases.small or phrases.few_shapes):
        return _match_in_blocks(docs, phrases, terms, keys, analyzed)
    else:
        counts = _read_counts(docs, phrases, analyzed)

    def matched(rows: DataFrame) -> DataFrame:
        return phrase.attach_terms(counts, rows, phrases)

    def result(rows: DataFrame, present: Column) -> DataFrame:
        flag = F.when(F.size("classification") > 0, present)
        return rows.select("docid", *keys, "classification", "hits", flag.alias("hierarchy_present"))

    decided = matched(terms.where(F.col("others").isNull()).drop("others"))
    open_ = matched(terms.where(F.col("others").isNotNull()).drop("lone"))
    present = counts.select("docid", "field", "gram", F.col("hits").alias("other_hits"))
    looked_up = open_.select(
        "docid", *keys, "classification", "field", "hits", F.explode("others").alias("gram")
    ).join(present, ["docid", "field", "gram"], "left")
    found = looked_up.groupBy("docid", *keys, "classification").agg(
        F.max("hits").alias("hits"), F.count("other_hits").alias("n_others")
    )
    return result(decided, F.col("lone")).unionByName(result(found, F.col("n_others") > 0))


def terms_that_occur(
    docs: DataFrame,
    phrases: phrase.Phrases,
    keys: Sequence[str] = ("dict_id", "term"),
    analyzed: DataFrame | None = None,
    postings: DataFrame | None = None,
) -> DataFrame:
    """The ``keys`` of every term that ``match_queries`` finds in any document, once each.

    A task shuffles each gram of its texts once; no document and none of its terms is shuffled.
    Terms beyond a broadcast are looked for in one of ``FIRST_SHARE`` documents, then those that
    are not found yet in all others, so that frequent grams are not shuffled by every task.
    """
    own = phrases.rows.where(F.col("entry") == F.col("term"))
    terms = own.select(*keys, "field", "gram")
    gram = ["field", "gram"]
    if postings is not None and phrases.number <= MOST_PHRASES:
        found = count_by_postings(postings, replace(phrases, rows=own))
        return terms.join(found.select(*gram).distinct(), gram, "left_semi").select(*keys)

    def forms(share: Column) -> DataFrame:
        if analyzed is not None:
            return _needed_forms(analyzed, phrases).where(share)
        return phrase.analyze_documents(docs.where(share), phrases.fields or [T.ENGLISH], starts=phrases.starts)

    if phrases.small or not phrases.few_shapes:
        found = phrase.find_phrases(forms(F.lit(True)), replace(phrases, rows=own))
        return terms.join(found.select(*gram).distinct(), gram, "left_semi").select(*keys)
    first = F.pmod(F.xxhash64("docid"), F.lit(FIRST_SHARE)) == 0
    some = phrase.wanted(own)
    early = settle(terms.join(phrase.find_candidates(forms(first), some, []).distinct(), gram, "left_semi"))
    left = terms.join(early.select(*gram).distinct(), gram, "left_anti")
    some = replace(some, grams=settle(key_bitmaps(left, gram)))
    late = settle(left.join(phrase.find_candidates(forms(~first), some, []).distinct(), gram, "left_semi"))
    return early.unionByName(late).select(*keys)


def match_terms_to_docs(
    dict_terms: DataFrame,
    dictionaries: DataFrame,
    docs: DataFrame,
    as_of: dt.datetime | None = None,
    from_date: dt.datetime | dt.date | None = None,
    analyzed: DataFrame | None = None,
    broadcast_bytes: int | None = None,
    postings: DataFrame | None = None,
    by_term: bool = False,
    among: DataFrame | None = None,
) -> DataFrame:
    """``terms_docs`` rows for whole dictionaries, ready for the upsert.

    A term with several classifications has one row per document; its greatest
    classification decides the flag.

    ``analyzed`` is a stored table of ``analyze_documents`` to be read instead of
    the texts, ``postings`` one of ``build_postings`` to look terms up in. They must hold
    every form that the dictionaries ask for and, for a ``from_date``, the documents'
    ``time``.

    With ``by_term`` the same rows hang on the terms that occur, by an outer join. Who reads
    distinct terms alone then makes no match, as Spark leaves such a join out; who reads more
    shuffles the matches to their terms.

    With ``among`` only the rows of its ``term``s are made, of every dictionary; they are the same.
    """
    if among is not None:
        dict_terms = dict_terms.join(among.select("term").distinct(), "term", "left_semi")
    if from_date is not None:
        docs = docs.where(since(from_date))
        analyzed = None if analyzed is None else analyzed.where(since(from_date))
        postings = None if postings is None else postings.where(since(from_date))
    one_each = dict_terms.groupBy("dict_id", "term").agg(F.max("classification").alias("classification"))
    phrases = compile_queries(with_field(one_each, dictionaries), broadcast_bytes=broadcast_bytes)
    rows = match_queries(docs, phrases, analyzed=analyzed, postings=postings)
    if by_term:
        found = terms_that_occur(docs, phrases, analyzed=analyzed, postings=postings)
        rows = found.join(rows, ["dict_id", "term"], "left")
    return rows.select(
        "term", "docid", "hits", stamp(as_of).alias("last_updated"), "hierarchy_present",
        "dict_id", F.lit(False).alias("from_percolation"),
    )


def catch_up(
    dict_terms: DataFrame,
    dictionaries: DataFrame,
    docs: DataFrame,
    as_of: dt.datetime | None = None,
    broadcast_bytes: int | None = None,
    analyzed: DataFrame | None = None,
    postings: DataFrame | None = None,
) -> DataFrame:
    """``terms_docs`` rows from the documents since each term's own ``last_updated``.

    A term without a date has never been matched and takes all documents.
    """
    known = dict_terms.groupBy("dict_id", "term").agg(
        F.when(F.count("last_updated") == F.count("*"), F.min("last_updated")).alias("_since")
    )
    oldest = known.agg(
        F.bool_and(F.col("_since").isNotNull()).alias("dated"), F.to_date(F.min("_since")).alias("since")
    ).first()
    from_date = oldest["since"] if oldest["dated"] else None
    rows = match_terms_to_docs(dict_terms, dictionaries, docs, as_of, from_date, analyzed, broadcast_bytes, postings)
    times = docs.select("docid", "time")
    if from_date is not None:
        times = times.where(since(from_date))
    recent = F.col("_since").isNull() | (F.col("time") >= F.date_trunc("day", "_since"))
    return rows.join(known, ["dict_id", "term"]).join(times, "docid").where(recent).select(*rows.columns)


def stamp(as_of: dt.datetime | None) -> Column:
    return F.current_timestamp() if as_of is None else instant(as_of)

"""Terms of dictionaries: refreshing them from a source, and removing them.

Each change computes all new tables first and returns them together; writing is
left to the caller, so a failed step leaves nothing half done.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.functions import strings as S
from termloom.operators.catalog import resolve
from termloom.operators.matching import stamp, with_field
from termloom.operators.upsert import delete_rows, touch
from termloom.schemas import NLP_TYPES

PAIR = ["term", "classification"]


@dataclass(frozen=True)
class Tables:
    """The tables that a dictionary is spread over.

    A change also says what it deletes: ``gone`` are (dict_id, term) whose matches go,
    ``lost`` the terms whose sentence rows go. Whoever keeps those tables in a way that
    rows can be hidden needs no rewriting.
    """

    dictionaries: DataFrame
    dict_terms: DataFrame
    terms_docs: DataFrame
    terms_docs_sentences: DataFrame
    stored_queries: DataFrame
    subset_meta: DataFrame | None = None
    gone: DataFrame | None = None
    lost: DataFrame | None = None


def incoming_pairs(terms: DataFrame) -> DataFrame:
    """Distinct (term, classification) of a source, stripped, without empty terms."""
    rows = terms.select(S.strip(F.col("term")).alias("term"), "classification")
    return rows.where(F.length("term") > 0).dropDuplicates(PAIR)


def terms_to_remove(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    return existing.select("term").distinct().join(incoming, "term", "left_anti")


def terms_to_add(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    return incoming.select("term").distinct().join(existing, "term", "left_anti")


def pairs_to_remove(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    return existing.select(*PAIR).distinct().join(incoming, PAIR, "left_anti")


def pairs_to_add(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    return incoming.select(*PAIR).distinct().join(existing, PAIR, "left_anti")


def append_terms(dict_terms: DataFrame, pairs: DataFrame, dict_id: int, as_of: dt.datetime | None) -> DataFrame:
    new = pairs.select(
        F.lit(dict_id).cast("int").alias("dict_id"), *PAIR, stamp(as_of).alias("last_updated")
    )
    return dict_terms.unionByName(new)


def register_queries(stored_queries: DataFrame, dict_terms: DataFrame, dictionaries: DataFrame) -> DataFrame:
    """Add a stored query for every (dict_id, term) that has none.

    A term with several classifications is registered with the smallest.
    """
    rows = with_field(dict_terms, dictionaries).select(
        S.query_id(F.col("dict_id"), F.col("term")).alias("id"), "dict_id", "term", "classification", "field"
    )
    first = rows.groupBy("id").agg(F.min(F.struct("term", "classification", "dict_id", "field")).alias("q"))
    new = first.select("id", "q.dict_id", "q.term", "q.classification", "q.field")
    return stored_queries.unionByName(new.join(stored_queries, "id", "left_anti"))


def unregister_queries(stored_queries: DataFrame, doomed: DataFrame) -> DataFrame:
    """Drop the stored queries of the (dict_id, term) rows in ``doomed``."""
    ids = doomed.select(S.query_id(F.col("dict_id"), F.col("term")).alias("id"))
    return delete_rows(stored_queries, ids, ["id"])


def unregister_dictionary(stored_queries: DataFrame, dictionaries: DataFrame, name: str) -> DataFrame:
    dict_id, _ = resolve(dictionaries, name)
    return stored_queries.where(~F.col("dict_id").eqNullSafe(dict_id))


def missing_queries(stored_queries: DataFrame, dict_terms: DataFrame) -> DataFrame:
    """(dict_id, term) without a stored query."""
    ids = dict_terms.select("dict_id", "term", S.query_id(F.col("dict_id"), F.col("term")).alias("id")).distinct()
    return ids.join(stored_queries, "id", "left_anti").select("dict_id", "term")


def held_elsewhere(dict_terms: DataFrame, doomed: DataFrame) -> DataFrame:
    """(term) of ``doomed`` rows that a dictionary outside ``doomed`` holds too."""
    others = dict_terms.select("dict_id", "term").join(doomed, ["dict_id", "term"], "left_anti")
    return doomed.select("term").distinct().join(others, "term", "left_semi")


def delete_terms(tables: Tables, doomed: DataFrame, whole_terms: bool = False) -> Tables:
    """Delete (dict_id, term, classification) rows with all that hangs on the term.

    Matches go for (dict_id, term). Sentence rows have no dictionary, so they
    stay while another dictionary holds the term. ``whole_terms`` takes every
    classification of a term; otherwise a stored query that was there is made again
    from the classifications that stay.
    """
    keys = ["dict_id", "term"]
    terms = doomed.select(*keys).distinct()
    lost = terms.select("term").distinct().join(held_elsewhere(tables.dict_terms, terms), "term", "left_anti")
    rest = delete_rows(tables.dict_terms, doomed, keys if whole_terms else [*keys, "classification"])
    stored = unregister_queries(tables.stored_queries, terms)
    if not whole_terms:
        ids = terms.select(S.query_id(F.col("dict_id"), F.col("term")).alias("id"))
        dropped = tables.stored_queries.join(ids, "id", "left_semi").select("id")
        staying = rest.withColumn("id", S.query_id(F.col("dict_id"), F.col("term")))
        staying = staying.join(dropped, "id", "left_semi").drop("id")
        stored = register_queries(stored, staying, tables.dictionaries)
    return replace(
        tables,
        dict_terms=rest,
        terms_docs=delete_rows(tables.terms_docs, terms, keys),
        terms_docs_sentences=delete_rows(tables.terms_docs_sentences, lost, ["term"]),
        stored_queries=stored,
        gone=terms,
        lost=lost,
    )


def _own_terms(tables: Tables, dict_id: int) -> DataFrame:
    """A dictionary's terms as compared, and as ``stored``."""
    rows = tables.dict_terms.where(F.col("dict_id") == dict_id)
    return rows.select(S.strip(F.col("term")).alias("term"), "classification", F.col("term").alias("stored"))


def _as_stored(existing: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of ``gone`` in the spelling under which they are stored."""
    keys = gone.columns
    rows = existing.join(gone, keys, "left_semi").withColumn("term", F.col("stored"))
    return rows.select(*keys).distinct()


def _add_pairs(tables: Tables, pairs: DataFrame, dict_id: int, as_of: dt.datetime | None) -> Tables:
    dict_terms = append_terms(tables.dict_terms, pairs, dict_id, as_of)
    dictionaries = touch(tables.dictionaries, F.col("dict_id") == dict_id, "last_updated", as_of)
    own = dict_terms.where(F.col("dict_id") == dict_id)
    stored = register_queries(tables.stored_queries, own, dictionaries)
    return replace(tables, dict_terms=dict_terms, dictionaries=dictionaries, stored_queries=stored)


def ingest(
    tables: Tables, dict_id: int, terms: DataFrame, update: bool = False, as_of: dt.datetime | None = None
) -> Tables:
    """Bring a dictionary in line with its source, comparing terms.

    Terms that left the source are deleted, new terms are added with all their
    classifications. With ``update`` every incoming term is deleted and added
    anew.
    """
    incoming = incoming_pairs(terms)
    existing = _own_terms(tables, dict_id)
    gone = _as_stored(existing, terms_to_remove(existing, incoming))
    if update:
        again = incoming.select("term").distinct()
        gone = gone.unionByName(_as_stored(existing, again)).unionByName(again)
        new = incoming
    else:
        new = incoming.join(terms_to_add(existing, incoming), "term", "left_semi")
    doomed = gone.select(F.lit(dict_id).cast("int").alias("dict_id"), "term")
    return _add_pairs(delete_terms(tables, doomed, whole_terms=True), new, dict_id, as_of)


def update(tables: Tables, dict_id: int, terms: DataFrame, as_of: dt.datetime | None = None) -> Tables:
    """Bring a dictionary in line with its source, comparing (term, classification).

    A removed pair takes the matches of its term with it; the stored query is
    made again from the pairs that stay.
    """
    incoming = incoming_pairs(terms)
    existing = _own_terms(tables, dict_id)
    gone = _as_stored(existing, pairs_to_remove(existing, incoming))
    new = pairs_to_add(existing, incoming)
    doomed = gone.select(F.lit(dict_id).cast("int").alias("dict_id"), *PAIR)
    return _add_pairs(delete_terms(tables, doomed), new, dict_id, as_of)


def remove_dictionary(tables: Tables, name: str) -> Tables:
    """Delete a dictionary, its terms, matches, stored queries and subset entries."""
    dict_id, name = resolve(tables.dictionaries, name)
    doomed = tables.dict_terms.where(F.col("dict_id") == dict_id)
    rest = delete_terms(tables, doomed, whole_terms=True)
    meta = tables.subset_meta
    if meta is not None:
        subsets = [f"{name}_{nlp_type}" for nlp_type in NLP_TYPES]
        meta = meta.where(~(F.col("dict_id").eqNullSafe(dict_id) & F.coalesce(F.col("subset_name").isin(subsets), F.lit(False))))
    return replace(
        rest, dictionaries=tables.dictionaries.where(~F.col("dict_id").eqNullSafe(dict_id)), subset_meta=meta
    )

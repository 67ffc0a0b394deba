"""Keyed changes to tables: upserts, deletes and stamps.

All of them return the new table. Plain Parquet has neither MERGE nor DELETE, so
a change is an anti-join and a union, and it must be written to another place
than the one being read.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.operators.matching import stamp
from termloom.schemas import TERMS_DOCS_KEYS


def last_write_wins(updates: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key by ``order``; ties go to the greatest row.

    An aggregate rather than a window, so that the rows of a hot key are reduced
    before the shuffle. A key with a null equals no other and is kept as it is.
    """
    rest = [c for c in updates.columns if c not in keys and c not in order]
    incomplete = F.lit(False)
    for key in keys:
        incomplete = incomplete | F.col(key).isNull()
    rows = updates.withColumn("_alone", F.when(incomplete, F.monotonically_increasing_id()))
    last = rows.groupBy(*keys, "_alone").agg(F.max(F.struct(*order, *rest)).alias("last"))
    columns = [F.col(c) if c in keys else F.col(f"last.{c}").alias(c) for c in updates.columns]
    return last.select(*columns)


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Rows of ``target`` whose key is not updated, and the last update per key."""
    updates = last_write_wins(updates, keys, order)
    return delete_rows(target, updates, keys).unionByName(updates.select(*target.columns))


def upsert_terms_docs(terms_docs: DataFrame, updates: DataFrame, order: Sequence[str] = ("last_updated",)) -> DataFrame:
    return upsert(terms_docs, updates, TERMS_DOCS_KEYS, order)


def upsert_documents(docs: DataFrame, arrivals: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Re-indexing a known docid replaces the whole document."""
    return upsert(docs, arrivals, ["docid"], order)


def delete_rows(table: DataFrame, doomed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``table`` whose key is not among ``doomed``."""
    return table.join(doomed.select(*keys), list(keys), "left_anti").select(*table.columns)


def touch(dictionaries: DataFrame, chosen: Column, column: str, as_of: dt.datetime | None = None) -> DataFrame:
    """Set ``last_updated`` or ``last_matched`` of the chosen dictionaries."""
    return dictionaries.withColumn(column, F.when(chosen, stamp(as_of)).otherwise(F.col(column)))

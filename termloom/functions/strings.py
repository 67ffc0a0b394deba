"""Small string and array expressions used by the sources and the catalog."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(text: Column) -> Column:
    """Trim every kind of white space (``trim`` only knows the space)."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def split_fields(line: Column) -> Column:
    """Comma-separated fields, each stripped; quotes mean nothing."""
    return F.transform(F.split(line, ","), strip)


def first_field(fields: Column) -> Column:
    return F.get(fields, F.lit(0))


def other_fields(fields: Column) -> Column:
    """The non-empty fields after the first."""
    rest = F.slice(fields, F.lit(2), F.greatest(F.size(fields) - 1, F.lit(0)))
    return F.filter(rest, lambda field: field != "")


def query_id(dict_id: Column, term: Column) -> Column:
    """Identifier of a stored query; a slash would split a path, so it is a bar."""
    return F.concat_ws("_", dict_id.cast("string"), F.replace(term, F.lit("/"), F.lit("|")))


def variant_path(keys: Sequence[str]) -> str:
    """Path expression for a list of object keys."""
    return "$" + "".join('["{}"]'.format(key.replace('"', '\\"')) for key in keys)


def lookup_paths(record: Column, dotted_paths: Sequence[str]) -> Column:
    """Values found at the dotted paths of a variant; a missing step gives none."""
    found = [
        F.try_variant_get(record, variant_path(path.split(".")), "string")
        for path in dotted_paths
    ]
    if not found:
        return F.array().cast("array<string>")
    return F.filter(F.array(*found), lambda value: value.isNotNull())


def subset_table(name: str, nlp_type: str) -> str:
    """Table name of one subset; only plain identifiers are accepted."""
    table = f"{name}_{nlp_type}"
    if not table.replace("_", "a").isalnum():
        raise ValueError(f"not a usable table name: {table!r}")
    return table

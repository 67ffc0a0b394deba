"""The catalog of dictionaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.functions import text as T

METADATA = [
    "dict_id", "name", "source", "json_path", "key", "base_classification",
    "classification_path", "case_sensitive", "users", "word_stemming",
]
REQUIRED = ["name", "source", "base_classification"]


def dict_by_name_ci(dictionaries: DataFrame, name: str) -> DataFrame:
    """The dictionary whose name is like ``name``; the first by id when several are."""
    return dictionaries.where(F.col("name").ilike(name)).orderBy("dict_id").limit(1)


def resolve(dictionaries: DataFrame, name: str) -> tuple[int, str]:
    """Id and name, as the catalog spells it, of the dictionary like ``name``."""
    found = dict_by_name_ci(dictionaries.select("dict_id", "name"), name).first()
    if found is None:
        raise ValueError(f"no such dictionary: {name!r}")
    return found["dict_id"], found["name"]


def get_dictionary_metadata(dictionaries: DataFrame, name: str) -> DataFrame:
    return dictionaries.where(F.col("name") == name).select(*METADATA)


def get_dictionary_metadata_by_id(dictionaries: DataFrame, dict_id: int) -> DataFrame:
    return dictionaries.where(F.col("dict_id") == dict_id).select(*METADATA)


def find_similar_dictionaries(
    dictionaries: DataFrame, name: str, source: str, base_classification: str
) -> DataFrame:
    """Dictionaries with a similar name, source or base classification.

    As in the lookup by name, ``%`` and ``_`` in the arguments are wildcards.
    """
    wanted = {"name": name, "source": source, "base_classification": base_classification}
    hit = F.lit(False)
    for column, value in wanted.items():
        hit = hit | F.col(column).ilike(f"%{value}%")
    return dictionaries.where(hit)


def list_terms(dictionaries: DataFrame, dict_terms: DataFrame, name: str) -> DataFrame:
    """Terms of one dictionary, repeated as they are stored."""
    owner = dict_by_name_ci(dictionaries, name).select("dict_id")
    return dict_terms.join(owner, "dict_id", "left_semi").select("term")


def list_dicts(dictionaries: DataFrame, verbose: bool = False) -> DataFrame:
    if verbose:
        return dictionaries.orderBy("dict_id")
    latest = F.col("last_updated").desc_nulls_first()
    return dictionaries.select("dict_id", "name", "last_updated").orderBy(latest)


def contents_fields(dictionaries: DataFrame) -> DataFrame:
    """(name, field): the analysed form each dictionary matches against."""
    field = T.contents_field(F.col("case_sensitive"), F.col("word_stemming"))
    return dictionaries.select("name", field.alias("field"))


def validate_dictionary(row: dict) -> None:
    missing = [column for column in REQUIRED if row.get(column) is None]
    if missing:
        raise ValueError(f"required for a dictionary: {', '.join(missing)}")


def append_dictionary(dictionaries: DataFrame, rows: DataFrame) -> DataFrame:
    """Add rows that may lack columns of the catalog."""
    return dictionaries.unionByName(rows, allowMissingColumns=True)


def add_dictionary(dictionaries: DataFrame, row: dict, force: bool = False) -> DataFrame:
    """Add one dictionary; ``force`` is the consent to a similar one."""
    validate_dictionary(row)
    if not force:
        twin = find_similar_dictionaries(
            dictionaries, row["name"], row["source"], row["base_classification"]
        ).orderBy("dict_id").select("dict_id").first()
        if twin is not None:
            raise ValueError(f"a similar dictionary exists already (id {twin['dict_id']})")
    fields = [field for field in dictionaries.schema.fields if field.name in row]
    schema = type(dictionaries.schema)(fields)
    new = dictionaries.sparkSession.createDataFrame([tuple(row[f.name] for f in fields)], schema)
    return append_dictionary(dictionaries, new)

"""Schemas of the tables."""

from __future__ import annotations

ARTICLES = (
    "docid string, contents string, title string, authors string, pubname string, URL string, "
    "startingPage string, endingPage string, filepath string, issue string, sha1 string, "
    "source string, vol string, time timestamp"
)
ANALYZED = "docid string, time timestamp, field string, toks array<string>"
DICTIONARIES = (
    "dict_id int, name string, source string, key string, json_path array<string>, "
    "base_classification string, classification_path array<string>, case_sensitive boolean, "
    "word_stemming boolean, users string, last_updated timestamp, last_matched timestamp"
)
DICT_TERMS = "dict_id int, term string, classification array<string>, last_updated timestamp"
TERMS_DOCS = (
    "term string, docid string, hits int, last_updated timestamp, hierarchy_present boolean, "
    "dict_id int, from_percolation boolean"
)
TERMS_DOCS_SENTENCES = "term string, docid string, sentid int, snippets string"
SENTENCES = "docid string, sentid int, words array<string>, nlp_type string"
SUBSET = "docid string, sentid int"
SUBSET_META = "dict_id int, subset_name string"
DELETED_TERMS = "dict_id int, term string, deleted timestamp"
STORED_QUERIES = "id string, dict_id int, term string, classification array<string>, field string"

TERMS_DOCS_KEYS = ["dict_id", "term", "docid"]

# The versions of the language processing that made the sentences.
NLP_TYPES = ["nlp", "nlp352", "nlp360"]

"""The registered queries once more, as SQL for another engine.

Phrase matches are written as relational division: every word of every text is a
row, a phrase is a set of (offset, word) rows, and a match is a start where all
rows of the phrase are met. Stems are made per distinct word.
"""

from __future__ import annotations

from termloom.plans.derived import FIXTURE_DICTIONARIES, FIXTURE_TERMS

STOP = (
    "a an and are as at be but by for if in into is it no not of on or such that the "
    "their then there these they this to was will with"
).split()

ENGLISH, CASED = "contents", "contents.case_sensitive"
NO_STEM, CASED_NO_STEM = "contents.no_stem", "contents.case_sensitive_no_stem"
FIELDS = [ENGLISH, CASED, NO_STEM, CASED_NO_STEM]

_LETTERS = r"[\p{L}\p{Nl}][\p{L}\p{Nl}\p{M}]*"
_DIGITS = r"\p{Nd}[\p{Nd}\p{M}]*"
_RUN = (
    rf"(?:{_LETTERS}(?:[:.''·‘’․‧＇．：]{_LETTERS})*"
    rf"|{_DIGITS}(?:[,;.''‘’․＇，．；]{_DIGITS})*)"
)
TOKEN = (
    r"[\p{Han}\p{Hiragana}]\p{M}*"
    rf"|\p{{Pc}}*{_RUN}+(?:\p{{Pc}}+{_RUN}+)*\p{{Pc}}*"
)


def quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def words_of(text: str) -> str:
    spaced = rf"regexp_replace({text}, '([\p{{Han}}\p{{Hiragana}}]\p{{M}}*)', ' \1 ', 'g')"
    return f"regexp_extract_all({spaced}, '{TOKEN}')"


STOP_LIST = "(" + ", ".join(map(quote, STOP)) + ")"


# Stemmer: one CASE per step over a table of distinct words.

_C, _V = "[^aeiou][^aeiouy]*", "[aeiouy][aeiou]*"
M0 = f"^({_C})?{_V}{_C}"
M1 = f"^({_C})?{_V}{_C}({_V})?$"
M2 = f"^({_C})?{_V}{_C}{_V}{_C}"
VOWEL = f"^({_C})?[aeiouy]"
CVC = f"^{_C}[aeiouy][^aeiouwxy]$"

STEP_2 = """ational:ate tional:tion enci:ence anci:ance izer:ize bli:ble alli:al entli:ent eli:e
ousli:ous ization:ize ation:ate ator:ate alism:al iveness:ive fulness:ful ousness:ous aliti:al
iviti:ive biliti:ble logi:log"""
STEP_3 = "icate:ic ative: alize:al iciti:ic ical:ic ful: ness:"
STEP_4 = "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize"


def _cut(n: int) -> str:
    return f"left(x, length(x) - {n})"


def _is(expr: str, pattern: str) -> str:
    return f"regexp_matches({expr}, '{pattern}')"


def _table_step(pairs: str, measure: str) -> str:
    entries = [p.split(":") if ":" in p else [p, ""] for p in pairs.split()]
    whens = []
    for suffix, ending in sorted(entries, key=lambda e: -len(e[0])):
        rest = _cut(len(suffix))
        test = _is(rest, measure)
        if suffix == "ion":
            test += f" AND {_is(rest, '[st]$')}"
        whens.append(f"WHEN ends_with(x, '{suffix}') THEN CASE WHEN {test} THEN {rest} || '{ending}' ELSE x END")
    return f"CASE {' '.join(whens)} ELSE x END"


STEM_STEPS = [
    "CASE WHEN length(x) <= 2 THEN x || chr(3) WHEN starts_with(x, 'y') THEN chr(2) || substr(x, 2) ELSE x END",
    f"""CASE WHEN ends_with(x, 'sses') OR ends_with(x, 'ies') THEN {_cut(2)}
        WHEN ends_with(x, 's') AND NOT ends_with(x, 'ss') THEN {_cut(1)} ELSE x END""",
    f"""CASE WHEN ends_with(x, 'eed') THEN CASE WHEN {_is(_cut(3), M0)} THEN {_cut(1)} ELSE x END
        WHEN ends_with(x, 'ed') THEN CASE WHEN {_is(_cut(2), VOWEL)} THEN chr(1) || {_cut(2)} ELSE x END
        WHEN ends_with(x, 'ing') THEN CASE WHEN {_is(_cut(3), VOWEL)} THEN chr(1) || {_cut(3)} ELSE x END
        ELSE x END""",
    f"""CASE WHEN NOT starts_with(x, chr(1)) THEN x
        WHEN {_is('x', '(at|bl|iz)$')} THEN substr(x, 2) || 'e'
        WHEN right(x, 1) = left(right(x, 2), 1) AND NOT {_is('x', '[aeiouylsz]$')} THEN left(substr(x, 2), length(x) - 2)
        WHEN {_is('substr(x, 2)', CVC)} THEN substr(x, 2) || 'e' ELSE substr(x, 2) END""",
    f"CASE WHEN ends_with(x, 'y') AND {_is(_cut(1), VOWEL)} THEN {_cut(1)} || 'i' ELSE x END",
    _table_step(STEP_2, M0),
    _table_step(STEP_3, M0),
    _table_step(STEP_4, M2),
    f"""CASE WHEN ends_with(x, 'e') AND ({_is(_cut(1), M2)} OR ({_is(_cut(1), M1)} AND NOT {_is(_cut(1), CVC)}))
        THEN {_cut(1)} ELSE x END""",
    f"CASE WHEN ends_with(x, 'll') AND {_is('x', M2)} THEN {_cut(1)} ELSE x END",
    f"CASE WHEN ends_with(x, chr(3)) THEN {_cut(1)} WHEN starts_with(x, chr(2)) THEN 'y' || substr(x, 2) ELSE x END",
]


def stems(words: str) -> str:
    """(w, x): the stem x of every distinct w of a query with a column w."""
    sql = f"SELECT DISTINCT w, w AS x FROM ({words}) WHERE w IS NOT NULL"
    for step in STEM_STEPS:
        sql = f"SELECT w, {step} AS x FROM ({sql})"
    return sql


# Texts as rows of words, in each analysed form.


def token_ctes(name: str, source: str, fields: list[str]) -> str:
    """``name``(id, field, pos, tok): words of ``source``(id, text[, field])."""
    has_field = "AS field" in source
    ctes = [
        f"{name}_w AS MATERIALIZED (SELECT * FROM (SELECT id, {'field,' if has_field else ''} "
        f"unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS pos FROM "
        f"(SELECT id, {'field,' if has_field else ''} {words_of('text')} AS ws FROM ({source}))))"
    ]
    parts = []
    for i, field in enumerate(fields):
        w = "lower(w)" if field in (ENGLISH, NO_STEM) else "w"
        if field in (ENGLISH, CASED):
            w = f"regexp_replace({w}, '[''’＇][sS]$', '')"
        masked = f"CASE WHEN {w} IN {STOP_LIST} THEN NULL ELSE {w} END"
        only = f" WHERE field = '{field}'" if has_field else ""
        ctes.append(f"{name}_{i} AS MATERIALIZED (SELECT id, pos, {masked} AS w FROM {name}_w{only})")
        if field in (ENGLISH, CASED):
            ctes.append(f"{name}_s{i} AS MATERIALIZED ({stems(f'SELECT w FROM {name}_{i}')})")
            parts.append(
                f"SELECT a.id, '{field}' AS field, a.pos, s.x AS tok FROM {name}_{i} a "
                f"LEFT JOIN {name}_s{i} s ON a.w = s.w"
            )
        else:
            parts.append(f"SELECT id, '{field}' AS field, pos, w AS tok FROM {name}_{i}")
    ctes.append(f"{name} AS MATERIALIZED ({' UNION ALL '.join(parts)})")
    return ",\n".join(ctes)


def match_ctes(terms: str, docs: str, fields: list[str], prefix: str = "") -> str:
    """``found``(dict_id, term, classification, field, docid, hits, hierarchy_present).

    ``terms`` gives (dict_id, term, classification, field), ``docs`` gives
    (id, text).
    """
    p = prefix
    return ",\n".join([
        f"{p}terms AS MATERIALIZED ({terms})",
        f"{p}spelled AS (SELECT field, term AS id FROM {p}terms UNION "
        f"SELECT field, c FROM (SELECT field, unnest(classification) AS c FROM {p}terms))",
        token_ctes(f"{p}d", docs, fields),
        token_ctes(f"{p}q", f"SELECT id, id AS text, field AS field FROM {p}spelled", fields),
        f"{p}pw AS (SELECT field, id, pos, tok, count(*) OVER (PARTITION BY field, id) AS n "
        f"FROM {p}q WHERE tok IS NOT NULL)",
        f"{p}starts AS (SELECT pw.field, pw.id AS phrase, d.id AS docid, d.pos - pw.pos AS start, any_value(pw.n) AS n "
        f"FROM {p}pw pw JOIN {p}d d ON d.field = pw.field AND d.tok = pw.tok "
        f"GROUP BY ALL HAVING count(*) = any_value(pw.n))",
        f"{p}hits AS MATERIALIZED (SELECT field, phrase, docid, count(*)::INTEGER AS hits FROM {p}starts GROUP BY ALL)",
        f"{p}others AS (SELECT DISTINCT t.dict_id, t.term, h.docid FROM "
        f"(SELECT dict_id, term, field, unnest(classification) AS c FROM {p}terms) t "
        f"JOIN {p}hits h ON h.field = t.field AND h.phrase = t.c WHERE t.c <> t.term)",
        f"{p}found AS MATERIALIZED (SELECT t.dict_id, t.term, t.classification, t.field, h.docid, h.hits, "
        f"CASE WHEN len(t.classification) > 0 THEN o.docid IS NOT NULL "
        f"OR len(list_filter(t.classification, lambda c: c <> t.term)) = 0 END AS hierarchy_present "
        f"FROM {p}terms t JOIN {p}hits h ON h.field = t.field AND h.phrase = t.term "
        f"LEFT JOIN {p}others o ON o.dict_id = t.dict_id AND o.term = t.term AND o.docid = h.docid)",
    ])


def field_case(cased: str, stemmed: str) -> str:
    return (
        f"CASE WHEN {cased} AND {stemmed} THEN '{CASED}' WHEN {cased} THEN '{CASED_NO_STEM}' "
        f"WHEN {stemmed} THEN '{ENGLISH}' ELSE '{NO_STEM}' END"
    )


def _array(values: list[str]) -> str:
    return "[" + ", ".join(map(quote, values)) + "]::VARCHAR[]"


_FIELD_OF = {
    i: {(0, 0): NO_STEM, (1, 0): CASED_NO_STEM, (0, 1): ENGLISH, (1, 1): CASED}[(int(c), int(s))]
    for i, _, c, s in FIXTURE_DICTIONARIES
}
FIXTURE = "SELECT * FROM (VALUES " + ", ".join(
    f"({i}, {quote(t)}, {_array(c)}, '{_FIELD_OF[i]}')" for i, t, c in FIXTURE_TERMS
) + ") AS f(dict_id, term, classification, field)"

DOCS = "SELECT doc_id AS id, text FROM documents"
_TIME = "TIMESTAMP '2020-01-01' + to_days((doc_id % 365)::INTEGER)"
RECENT = f"{DOCS} WHERE {_TIME} >= TIMESTAMP '2020-06-01'"

FOUND = "WITH " + match_ctes(FIXTURE, DOCS, FIELDS)
FOUND_SINCE = "WITH " + match_ctes(FIXTURE, RECENT, FIELDS)

# Tables derived from the given ones.

CATALOG = f"""SELECT s_suppkey::INTEGER AS dict_id, s_name AS name, 'lists/' || lower(s_name) || '.csv' AS source,
    n_name AS base_classification, s_acctbal > 5000 AS case_sensitive, s_suppkey % 2 = 0 AS word_stemming,
    {field_case('s_acctbal > 5000', 's_suppkey % 2 = 0')} AS field,
    strftime(TIMESTAMP '2020-01-01' + to_days(s_suppkey::INTEGER), '%Y-%m-%d %H:%M:%S') AS last_updated
    FROM supplier JOIN nation ON s_nationkey = n_nationkey"""

SPOKEN = r"""SELECT (conv_id % 10)::INTEGER AS dict_id, array_to_string(ws[i : i + 1], ' ') AS term,
    CASE WHEN role = 'user' THEN ws[i + 2 : i + 2] ELSE []::VARCHAR[] END AS classification, role
    FROM (SELECT *, unnest(range(1, greatest(len(ws), 2))) AS i FROM (SELECT conv_id, role,
    regexp_extract_all(text, '[\p{L}\p{N}]+') AS ws FROM conversations) WHERE len(ws) > 0)"""

SPOKEN_TERMS = f"""SELECT t.dict_id, t.term, max(t.classification) AS classification, c.field
    FROM (SELECT DISTINCT dict_id, term, classification FROM ({SPOKEN})) t JOIN ({CATALOG}) c USING (dict_id)
    GROUP BY t.dict_id, t.term, c.field"""
SPOKEN_FOUND_SINCE = "WITH " + match_ctes(SPOKEN_TERMS, RECENT, FIELDS)

PARTS = """SELECT DISTINCT (p_partkey % 10)::INTEGER AS dict_id, p_name || '/' || p_type AS term, p_brand AS brand FROM part"""

LINES = """SELECT p_name || '/' || p_type AS term, l_orderkey AS docid, l_quantity::INTEGER AS hits,
    l_shipdate AS last_updated, CASE WHEN l_returnflag <> 'R' THEN l_returnflag = 'A' END AS hierarchy_present,
    (l_suppkey % 10)::INTEGER AS dict_id, l_linestatus = 'O' AS from_percolation, l_linenumber AS sentid
    FROM lineitem JOIN part ON l_partkey = p_partkey"""

OLD_SAID = f"SELECT DISTINCT dict_id, term, classification FROM ({SPOKEN}) WHERE role = 'user'"
OLD_AND_NEW_SAID = f"SELECT DISTINCT dict_id, term, classification FROM ({SPOKEN})"
NEW_SAID = f"SELECT DISTINCT term, classification FROM ({SPOKEN}) WHERE role = 'assistant'"
SAID = f"WITH old AS ({OLD_SAID}), new AS ({NEW_SAID}), own AS (SELECT * FROM old WHERE dict_id = 3)"

_STAMP = "'2024-01-01 00:00:00'"
_CLASSES = "array_to_string(classification, '|') AS classification"


def sentences(nlp_type: str) -> str:
    split = {
        "nlp": r"string_split(text, chr(10))",
        "nlp352": r"string_split(text, '.')",
        "nlp360": r"string_split(replace(text, chr(10), '.'), '.')",
    }[nlp_type]
    return (
        f"SELECT docid, unnest(ss) AS line, unnest(range(1, len(ss) + 1))::INTEGER AS sentid "
        f"FROM (SELECT doc_id AS docid, {split} AS ss FROM documents)"
    )


def match_one(field: str, dict_id: int) -> str:
    terms = f"SELECT dict_id, term, []::VARCHAR[] AS classification, '{field}' AS field FROM ({FIXTURE}) WHERE dict_id = {dict_id}"
    return f"WITH {match_ctes(terms, DOCS, [field])} SELECT term, docid, hits FROM found"


def analyzed(field: str) -> str:
    return (
        f"WITH {token_ctes('d', DOCS, [field])} SELECT doc_id AS docid, coalesce(toks, '') AS toks FROM documents "
        f"LEFT JOIN (SELECT id, string_agg(coalesce(tok, '_'), ' ' ORDER BY pos) AS toks FROM d GROUP BY id) "
        f"ON id = doc_id"
    )


def subset(nlp_type: str, docs: str) -> str:
    return f"SELECT docid, sentid FROM ({sentences(nlp_type)}) WHERE docid IN ({docs})"


WORD = r"[^\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}]"
SENTENCE_TEST = rf"contains(lower(line), lower(term)) AND regexp_matches(line, '(^|{WORD})(?i:' || regexp_escape(term) || ')($|{WORD})')"

_LIVE = """live AS (SELECT dict_id, term, count(DISTINCT docid) AS n_live FROM found GROUP BY ALL),
    stored AS (SELECT term, count(DISTINCT docid) AS n_stored FROM s_found GROUP BY ALL),
    compared AS (SELECT t.dict_id, t.term, coalesce(n_stored, 0) AS n_stored, coalesce(n_live, 0) AS n_live
        FROM terms t LEFT JOIN stored USING (term) LEFT JOIN live USING (dict_id, term))"""
BOTH = f"WITH {match_ctes(FIXTURE, DOCS, FIELDS)}, {match_ctes(FIXTURE, RECENT, FIELDS, 's_')}, {_LIVE}"
SPOKEN_BOTH = f"WITH {match_ctes(SPOKEN_TERMS, DOCS, FIELDS)}, {match_ctes(SPOKEN_TERMS, RECENT, FIELDS, 's_')}, {_LIVE}"

_ID = "dict_id || '_' || replace(term, '/', '|')"


def sampled(rows: str, below: str, limit: int, order: str) -> str:
    """Rows of the lowest hashes, at most ``limit`` per dictionary."""
    return (
        f"SELECT dict_id, term FROM ({rows}) WHERE substr(md5(term), 1, 8) < '{below}' "
        f"QUALIFY row_number() OVER (PARTITION BY dict_id ORDER BY md5(term), term, {order}) <= {limit}"
    )



ORACLES = {
    "match_no_stem": match_one(NO_STEM, 1),
    "match_case_sensitive_no_stem": match_one(CASED_NO_STEM, 2),
    "match_english": match_one(ENGLISH, 3),
    "match_case_sensitive": match_one(CASED, 4),
    "match_by_dictionary": f"{FOUND} SELECT dict_id, term, docid, hits FROM found",
    "match_hierarchy": f"{FOUND} SELECT dict_id, term, docid, hits, hierarchy_present FROM found",
    "match_since": f"{FOUND_SINCE} SELECT dict_id, term, docid, hits FROM found",
    "catch_up": f"""{FOUND} SELECT dict_id, term, docid, hits, hierarchy_present FROM found
        JOIN documents ON doc_id = docid
        WHERE {_TIME} >= make_timestamp(2020, 2 * dict_id, 15, 0, 0, 0)""",
    "match_spoken_terms": f"WITH {match_ctes(SPOKEN_TERMS, DOCS, FIELDS)} "
        "SELECT dict_id, term, docid, hits, hierarchy_present FROM found",
    "highlight_snippets": f"""WITH {match_ctes(
        f"SELECT dict_id, term, []::VARCHAR[] AS classification, field FROM ({FIXTURE}) WHERE dict_id = 1", DOCS, [NO_STEM])},
        ends AS (SELECT id, min(pos) AS lo, max(pos) AS hi FROM pw GROUP BY id),
        hit AS (SELECT phrase AS term, docid, start + lo AS first, start + hi AS last FROM starts JOIN ends ON id = phrase),
        lists AS (SELECT doc_id AS docid, {words_of('text')} AS ws FROM documents)
        SELECT term, docid, first::INTEGER AS start, array_to_string(ws[greatest(first - 2, 1) : last + 2], ' ') AS snippet
        FROM hit JOIN lists USING (docid)""",
    "tokenize_counts": f"SELECT doc_id AS docid, len({words_of('text')})::INTEGER AS n_tokens FROM documents",
    "analyze_english": analyzed(ENGLISH),
    "analyze_case_sensitive": analyzed(CASED),
    "analyze_masked": analyzed(NO_STEM),
    "analyze_case_sensitive_masked": analyzed(CASED_NO_STEM),
    "strip_possessive": f"""SELECT conv_id, turn, array_to_string(list_transform(
        {words_of("replace(text, ' ', CASE WHEN role = 'user' THEN '''s ' ELSE '’S ' END)")},
        lambda w: regexp_replace(w, '[''’＇][sS]$', '')), ' ') AS stripped FROM conversations""",
    "list_terms": f"""SELECT p.term FROM (SELECT DISTINCT dict_id, term, brand FROM ({PARTS})) p
        WHERE dict_id = (SELECT min(dict_id) FROM ({CATALOG}) WHERE name ILIKE 'supplier#00000000_')""",
    "list_dicts": f"SELECT dict_id, name, last_updated FROM ({CATALOG})",
    "list_dicts_verbose": f"""SELECT dict_id, name, source, base_classification, case_sensitive, word_stemming, last_updated
        FROM ({CATALOG})""",
    "dict_by_name": f"""SELECT dict_id, name, source, base_classification, case_sensitive, word_stemming
        FROM ({CATALOG}) WHERE name = 'Supplier#000000003'""",
    "dict_by_id": f"""SELECT dict_id, name, source, base_classification, case_sensitive, word_stemming
        FROM ({CATALOG}) WHERE dict_id = 5""",
    "similar_dicts": f"""SELECT dict_id, name, source, base_classification FROM ({CATALOG})
        WHERE name ILIKE '%00007%' OR source ILIKE '%supplier#00000001_.CSV%' OR base_classification ILIKE '%tion_2%'""",
    "add_dictionary": f"""SELECT dict_id, name, source, base_classification, case_sensitive FROM ({CATALOG})
        UNION ALL SELECT 100000, 'minerals', 'minerals.csv', 'rock', NULL""",
    "contents_field": f"SELECT name, field FROM ({CATALOG})",
    "csv_terms": "SELECT p_name AS term, p_type || '|' || p_brand AS classification FROM part",
    "json_terms": """SELECT p_name AS term, p_brand AS classification FROM part
        UNION ALL SELECT p_type, '' FROM part""",
    "terms_to_add": f"{SAID} SELECT DISTINCT term FROM new WHERE term NOT IN (SELECT term FROM old)",
    "terms_to_remove": f"{SAID} SELECT DISTINCT term FROM old WHERE term NOT IN (SELECT term FROM new)",
    "pairs_to_add": f"""{SAID} SELECT term, {_CLASSES} FROM
        (SELECT term, classification FROM new EXCEPT SELECT term, classification FROM old)""",
    "pairs_to_remove": f"""{SAID} SELECT term, {_CLASSES} FROM
        (SELECT term, classification FROM old EXCEPT SELECT term, classification FROM new)""",
    "ingest_terms": f"""{SAID} SELECT dict_id, term, {_CLASSES}, NULL::VARCHAR AS last_updated FROM old
        WHERE dict_id <> 3 OR term IN (SELECT term FROM new)
        UNION ALL SELECT 3, term, {_CLASSES}, {_STAMP} FROM new WHERE term NOT IN (SELECT term FROM own)""",
    "ingest_terms_anew": f"""{SAID} SELECT dict_id, term, {_CLASSES}, NULL::VARCHAR AS last_updated FROM old WHERE dict_id <> 3
        UNION ALL SELECT 3, term, {_CLASSES}, {_STAMP} FROM new""",
    "update_terms": f"""{SAID} SELECT dict_id, term, {_CLASSES}, NULL::VARCHAR AS last_updated FROM old
        WHERE dict_id <> 3 OR (term, classification) IN (SELECT (term, classification) FROM new)
        UNION ALL SELECT 3, term, {_CLASSES}, {_STAMP} FROM
        (SELECT term, classification FROM new EXCEPT SELECT term, classification FROM own)""",
    "upsert_matches": f"""WITH l AS ({LINES}), u AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
            PARTITION BY dict_id, term, docid
            ORDER BY last_updated DESC, hits DESC, hierarchy_present DESC NULLS LAST) AS rn
            FROM l WHERE from_percolation) WHERE rn = 1),
        r AS (SELECT * FROM u UNION ALL SELECT * FROM l WHERE NOT from_percolation
            AND NOT EXISTS (SELECT 1 FROM u WHERE u.dict_id = l.dict_id AND u.term = l.term AND u.docid = l.docid))
        SELECT term, docid, hits, strftime(last_updated, '%Y-%m-%d %H:%M:%S') AS last_updated, hierarchy_present,
            dict_id, from_percolation FROM r""",
    "upsert_documents": """SELECT coalesce(item_id, doc_id) AS docid,
        length(CASE WHEN item_id IS NULL THEN d.text ELSE b.text END)::INTEGER AS n_chars
        FROM documents d FULL JOIN benchmark b ON doc_id = item_id""",
    "delete_term": f"""WITH p AS ({PARTS}), l AS ({LINES}), gone AS (SELECT * FROM p WHERE brand = 'Brand#17'),
        pair AS (SELECT DISTINCT dict_id, term FROM gone),
        kept AS (SELECT DISTINCT term FROM p WHERE (dict_id, term) NOT IN (SELECT (dict_id, term) FROM pair))
        SELECT 'dict_terms' AS kind, dict_id, term AS item FROM p WHERE brand <> 'Brand#17'
        UNION ALL SELECT 'terms_docs', dict_id, term || '@' || docid FROM l
            WHERE (dict_id, term) NOT IN (SELECT (dict_id, term) FROM pair)
        UNION ALL SELECT 'terms_docs_sentences', NULL, term || '@' || docid || '@' || sentid FROM l
            WHERE term NOT IN (SELECT term FROM pair) OR term IN (SELECT term FROM kept)
        UNION ALL SELECT 'stored_queries', * FROM (SELECT DISTINCT dict_id, {_ID} FROM p WHERE brand <> 'Brand#17')""",
    "remove_dictionary": f"""WITH p AS ({PARTS}), l AS ({LINES}), own AS (SELECT DISTINCT term FROM p WHERE dict_id = 4),
        c AS ({CATALOG})
        SELECT 'dictionaries' AS kind, dict_id, name AS item FROM c WHERE dict_id <> 4
        UNION ALL SELECT 'dict_terms', dict_id, term FROM p WHERE dict_id <> 4
        UNION ALL SELECT 'terms_docs', dict_id, term || '@' || docid FROM l
            WHERE dict_id <> 4 OR term NOT IN (SELECT term FROM own)
        UNION ALL SELECT 'terms_docs_sentences', NULL, term || '@' || docid || '@' || sentid FROM l
            WHERE term NOT IN (SELECT term FROM own) OR term IN (SELECT term FROM p WHERE dict_id <> 4)
        UNION ALL SELECT 'stored_queries', * FROM (SELECT DISTINCT dict_id, {_ID} FROM p WHERE dict_id <> 4)
        UNION ALL SELECT 'subset_meta', s_suppkey::INTEGER, s_name || '_nlp' FROM supplier
            WHERE NOT (s_suppkey = 4 AND s_name || '_nlp' IN (SELECT name || v FROM c,
                (VALUES ('_nlp'), ('_nlp352'), ('_nlp360')) AS versions(v) WHERE dict_id = 4))""",
    "touch_dictionaries": f"""SELECT dict_id, last_updated,
        CASE WHEN base_classification = 'NATION_3' THEN {_STAMP} END AS last_matched FROM ({CATALOG})""",
    "match_sentences": f"""{FOUND} SELECT DISTINCT term, docid, sentid, line AS snippets FROM ({sentences('nlp')}) s
        JOIN (SELECT DISTINCT term, docid FROM found WHERE term IN (SELECT term FROM terms WHERE dict_id = 1)) f USING (docid)
        WHERE {SENTENCE_TEST} AND NOT (term = 'from' AND docid IN (SELECT doc_id FROM documents WHERE source = 'src3'))""",
    "match_sentences_regex": f"""{FOUND} SELECT DISTINCT term, docid, sentid, line AS snippets FROM ({sentences('nlp')}) s
        JOIN (SELECT DISTINCT term, docid FROM found) f USING (docid) WHERE {SENTENCE_TEST}""",
    **{
        f"subset_{v}": f"{FOUND} {subset(v, 'SELECT docid FROM found WHERE dict_id = 1')}"
        for v in ("nlp", "nlp352", "nlp360")
    },
    "overlap_all_terms": f"""{FOUND} {subset('nlp', '''
        SELECT docid FROM found WHERE term IN (SELECT term FROM terms WHERE dict_id = 1) INTERSECT
        SELECT docid FROM found WHERE term IN (SELECT term FROM terms WHERE dict_id = 3)''')}""",
    "overlap_listed_terms": f"""{FOUND} {subset('nlp', '''
        SELECT docid FROM found WHERE term IN ('from') INTERSECT
        SELECT docid FROM found WHERE term IN ('er', 'THE')''')}""",
    "subset_registry": """SELECT s_suppkey::INTEGER AS dict_id, s_name || '_nlp' AS subset_name FROM supplier
        WHERE s_suppkey NOT IN (3, 5) UNION ALL SELECT 3, 'Supplier#000000003_nlp'
        UNION ALL SELECT 0, 'Supplier#000000005_nlp'""",
    "stored_query_ids": f"""SELECT {_ID} AS id, term, min(brand) AS classification, field
        FROM ({PARTS}) JOIN ({CATALOG}) USING (dict_id) GROUP BY dict_id, term, field""",
    "missing_stored_queries": f"""WITH p AS ({PARTS}) SELECT DISTINCT dict_id, term FROM p
        WHERE (dict_id, term) NOT IN (SELECT (dict_id, term) FROM p WHERE brand <> 'Brand#17')""",
    "unregister_queries": f"""WITH p AS ({PARTS}) SELECT DISTINCT {_ID} AS id FROM p
        WHERE (dict_id, term) NOT IN (SELECT (dict_id, term) FROM p WHERE brand = 'Brand#17')""",
    "percolate_batch": f"""{FOUND} SELECT docid, string_agg({_ID}, '|' ORDER BY {_ID}) AS ids FROM found
        WHERE coalesce(hierarchy_present, true) GROUP BY docid""",
    "percolate_stream": f"""{FOUND} SELECT term, docid, hits, hierarchy_present, dict_id, true AS from_percolation
        FROM found WHERE coalesce(hierarchy_present, true)""",
    "fold_stream": f"""WITH {match_ctes(FIXTURE, DOCS, FIELDS)}, {match_ctes(FIXTURE, RECENT, FIELDS, 's_')},
        streamed AS (SELECT * FROM found WHERE coalesce(hierarchy_present, true))
        SELECT term, docid, hits, hierarchy_present, dict_id, true AS from_percolation FROM streamed
        UNION ALL SELECT term, docid, hits, hierarchy_present, dict_id, false FROM s_found
        ANTI JOIN streamed USING (dict_id, term, docid)""",
    "match_kept_form": f"{FOUND_SINCE} SELECT dict_id, term, docid, hits, hierarchy_present FROM found",
    "corpus_match": f"{FOUND} SELECT dict_id, term, docid, hits, hierarchy_present FROM found",
    "corpus_fix_freshness": f"{FOUND} SELECT dict_id, term, docid, hits, hierarchy_present FROM found WHERE dict_id = 1",
    "corpus_fold": f"""WITH {match_ctes(FIXTURE, DOCS, FIELDS)}, {match_ctes(FIXTURE, RECENT, FIELDS, 's_')},
        streamed AS (SELECT * FROM found WHERE coalesce(hierarchy_present, true) AND NOT (dict_id = 1 AND term = 'hehely')),
        newer AS (SELECT * FROM s_found WHERE dict_id = 1 AND term <> 'hehely')
        SELECT term, docid, hits, hierarchy_present, dict_id, false AS from_percolation FROM newer
        UNION ALL SELECT term, docid, hits, hierarchy_present, dict_id, true FROM streamed
        ANTI JOIN newer USING (dict_id, term, docid)""",
    "doc_exists": """SELECT DISTINCT doc_id * 3 AS docid, doc_id * 3 IN (SELECT doc_id FROM documents) AS found FROM labels""",
    "scan_matching": "SELECT doc_id AS docid FROM documents WHERE source = 'src3' ORDER BY doc_id LIMIT 50",
    "sample_terms_hash": sampled(PARTS, "80000000", 5, "brand"),
    "unmatched_terms": f"""{SPOKEN_FOUND_SINCE} SELECT dict_id, term FROM
        (SELECT DISTINCT dict_id, term, classification FROM ({SPOKEN})) WHERE term NOT IN (SELECT term FROM found)""",
    "stored_live_counts": f"{BOTH} SELECT dict_id, term, n_stored, n_live FROM compared",
    "freshness_summary": f"""{BOTH} SELECT dict_id, count(*) FILTER (n_live <= n_stored) AS n_good,
        count(*) FILTER (n_live > n_stored) AS n_bad, bool_and(n_live <= n_stored) AS fresh FROM compared GROUP BY dict_id""",
    "health_summary": f"""{SPOKEN_BOTH},
        picked AS ({sampled(OLD_AND_NEW_SAID, "19999999", 1000, "classification")}),
        registered AS (SELECT DISTINCT dict_id, term FROM ({SPOKEN}) WHERE len(classification) > 0),
        missing AS (SELECT dict_id, count(*) AS n_missing FROM (SELECT dict_id, term FROM terms
            WHERE term NOT IN (SELECT term FROM s_found)
            EXCEPT SELECT dict_id, term FROM registered) GROUP BY dict_id),
        checked AS (SELECT dict_id, count(*) FILTER (n_live <> n_stored) AS n_mismatched, count(*) AS n_checked
            FROM compared SEMI JOIN picked USING (dict_id, term) GROUP BY dict_id)
        SELECT c.dict_id, coalesce(n_missing, 0) AS n_missing, coalesce(n_mismatched, 0) AS n_mismatched,
            coalesce(n_checked, 0) AS n_checked,
            coalesce(n_missing, 0) = 0 AND coalesce(n_mismatched, 0) = 0 AS healthy
        FROM ({CATALOG}) c LEFT JOIN missing USING (dict_id) LEFT JOIN checked USING (dict_id)""",
}

"""Text analysis: tokens with positions, and the four analysed forms of a text.

An analysed text is an array of nullable strings. The index in the array is the
token's position; a null is a hole left by a stop word, so that distances inside
a phrase are kept.

The analysers are built as SQL text over named columns (see ``stemmer``); every
function ending in ``_sql`` takes and returns SQL, the others return columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from termloom.functions.stemmer import mark, stem_marked_sql

# The 33-word default English stop list.
STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in",
    "into", "is", "it", "no", "not", "of", "on", "or", "such", "that", "the",
    "their", "then", "there", "these", "they", "this", "to", "was", "will", "with",
)

# The names of the analysed forms of the document text.
ENGLISH = "contents"
CASE_SENSITIVE = "contents.case_sensitive"
NO_STEM = "contents.no_stem"
CASE_SENSITIVE_NO_STEM = "contents.case_sensitive_no_stem"
FIELDS = (ENGLISH, CASE_SENSITIVE, NO_STEM, CASE_SENSITIVE_NO_STEM)

_LOWER = {ENGLISH, NO_STEM}
STEMMED = {ENGLISH, CASE_SENSITIVE}

# Words by the Unicode text segmentation rules (UAX #29): letters may be joined
# by one of : ' . and digits by one of , ; ' . ; ideographs and hiragana stand
# alone; underscores glue. Possessive quantifiers keep the matcher iterative, so
# that a very long token cannot overflow the stack.
_EXTEND = r"\p{M}­‌‍"
_NOT_IDEOGRAPH = r"&&[^\p{IsHan}\p{IsHiragana}]"
# Scripts are told by a search, which plain letters are spared. Most words are plain: a run
# of Latin-1 letters that no neighbour joins or continues. They are tried first, with
# classes of single bytes only; any other place is given up at once unless a word can begin there.
_OTHER = r"(?![\x00-\x7F])"
_BEYOND = r"\x{80}-\x{10FFFF}"
_PLAIN = rf"[a-zA-ZÀ-ÖØ-öø-ÿ]++(?![0-9_{_BEYOND}]|[:.'][a-zA-Z{_BEYOND}])"
_NO_WORD = r"(?![\x00-/:-@\[-^`{-\x7F])"
_LETTERS = (
    rf"(?:[a-zA-Z]|{_OTHER}[\p{{L}}\p{{Nl}}{_NOT_IDEOGRAPH}])"
    rf"(?:[a-zA-Z]++|{_OTHER}[\p{{L}}\p{{Nl}}{_EXTEND}{_NOT_IDEOGRAPH}])*+"
)
_DIGITS = rf"\p{{Nd}}[\p{{Nd}}{_EXTEND}]*+"
_RUN = (
    rf"(?:{_LETTERS}(?:[:.'·‘’․‧＇．：]{_LETTERS})*+"
    rf"|{_DIGITS}(?:[,;.'‘’․＇，．；]{_DIGITS})*+)"
)
TOKEN = (
    rf"(?:{_PLAIN}|{_NO_WORD}(?:{_OTHER}[\p{{IsHan}}\p{{IsHiragana}}][{_EXTEND}]*+"
    rf"|(?<!\p{{Pc}})\p{{Pc}}*+{_RUN}++(?:\p{{Pc}}++{_RUN}++)*+\p{{Pc}}*+))"
)

# Runs of word characters and runs of anything else; together they spell the
# whole text, and every run border is a word boundary, as it is for regular
# expressions with Unicode classes.
_WORD = r"\p{IsAlphabetic}\p{M}\p{Nd}\p{Pc}\p{IsJoin_Control}"
WORD_CHARACTER = f"[{_WORD}]"
PIECE = rf"[{_WORD}]++|[^{_WORD}]++"

_POSSESSIVE = "['’＇][sS]$"


def _quote(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def tokenize_sql(text: str) -> str:
    """All words of ``text`` in order."""
    return f"regexp_extract_all({text}, {_quote(TOKEN)}, 0)"


def lower_tokens_sql(tokens: str) -> str:
    """Lower case of all tokens; a token never holds a space."""
    return f"if(size({tokens}) > 0, split(lower(array_join({tokens}, ' ')), ' '), {tokens})"


def strip_possessive_sql(token: str) -> str:
    """``token`` without a trailing 's."""
    return f"regexp_replace({token}, {_quote(_POSSESSIVE)}, '')"


def mask_stop_word_sql(token: str, stop_words: Sequence[str] = STOP_WORDS) -> str:
    """Null for a stop word, else ``token``."""
    if not stop_words:
        return token
    return f"if({token} IN ({', '.join(map(_quote, stop_words))}), NULL, {token})"


def analyze_sql(
    field: str, words: str, stop_words: Sequence[str] = STOP_WORDS, starts: Sequence[str] | None = None
) -> str:
    """The analysed form ``field`` of a text, given its words as an array.

    ``words`` are in lower case already where the form wants them so. With ``starts``
    only words that begin with one of them are stemmed, the others become holes.
    """
    if field not in STEMMED:
        return f"transform({words}, t -> {mask_stop_word_sql('t', stop_words)})"

    # Few tokens end in s, so the possessive and what follows from it are kept
    # away from the rest.
    stripped = f"get(transform(array({strip_possessive_sql('t')}), p -> {_prepare('p', stop_words)}), 0)"
    ready = f"if(endswith(t, 's') OR endswith(t, 'S'), {stripped}, {_prepare('t', stop_words)})"
    if starts is None:
        return stem_marked_sql(f"transform({words}, t -> {ready})")
    return f"transform({words}, t -> if({_begins('t', starts)}, get({stem_marked_sql(f'array({ready})')}, 0), NULL))"


def _begins(token: str, starts: Sequence[str]) -> str:
    """Whether a token begins with one of ``starts``, which have up to two characters."""
    tests = []
    for length in (1, 2):
        some = [start for start in starts if len(start) == length]
        if some:
            tests.append(f"left({token}, {length}) IN ({', '.join(map(_quote, some))})")
    return " OR ".join(tests) or "false"


def _prepare(token: str, stop_words: Sequence[str]) -> str:
    """Null for a stop word, else the token marked for the stemmer."""
    if not stop_words:
        return mark(token)
    return f"if({token} IN ({', '.join(map(_quote, stop_words))}), NULL, {mark(token)})"


def _words_sql(field: str, text: str) -> str:
    return tokenize_sql(f"lower({text})" if field in _LOWER else text)


def analyze(field: str, text: str, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """The analysed form named ``field`` of the SQL expression ``text``."""
    return F.expr(analyze_sql(field, _words_sql(field, text), stop_words))


def analyze_english(text: str, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """Possessives stripped, lower case, stop words out, stemmed."""
    return analyze(ENGLISH, text, stop_words)


def analyze_case_sensitive(text: str, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """As ``analyze_english`` but case is kept, so only lower-case stop words go."""
    return analyze(CASE_SENSITIVE, text, stop_words)


def analyze_no_stem(text: str, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """Lower case, stop words out."""
    return analyze(NO_STEM, text, stop_words)


def analyze_case_sensitive_no_stem(text: str, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """Stop words out, nothing else."""
    return analyze(CASE_SENSITIVE_NO_STEM, text, stop_words)


def analyze_by_field(
    field: str, text: str, fields: Sequence[str] = FIELDS, stop_words: Sequence[str] = STOP_WORDS
) -> Column:
    """The analysed form of ``text`` chosen per row by the ``field`` column."""
    cases = " ".join(
        f"WHEN {_quote(name)} THEN {analyze_sql(name, _words_sql(name, text), stop_words)}"
        for name in fields
    )
    return F.expr(f"CASE {field} {cases} END")


def searchable_sql(
    field: str, words: str, lowered: str, stop_words: Sequence[str] = STOP_WORDS, starts: Sequence[str] | None = None
) -> str:
    """Document tokens good for matching analysed phrases, from the text's words.

    A phrase never holds a stop word, so without stemming an unmasked stop word
    in a document can only ever fill a hole, as its null would. Leaving it in
    saves a lambda per token. A stem, however, may equal a stop word, so the
    stemmed forms are masked in full. With ``starts`` words that begin otherwise are not stemmed.
    """
    source = lowered if field in _LOWER else words
    return analyze_sql(field, source, stop_words, starts) if field in STEMMED else source


def case_sensitive_sql(
    words: str, lowered: str, english: str, stop_words: Sequence[str] = STOP_WORDS, starts: Sequence[str] | None = None
) -> str:
    """The form ``CASE_SENSITIVE`` of words whose lower case and form ``ENGLISH`` are known.

    Only words that are not in lower case are stemmed. ``english`` must be a column, or it would
    be made again for every word.
    """
    own = f"get({analyze_sql(CASE_SENSITIVE, 'array(w)', stop_words, starts)}, 0)"
    return f"transform({words}, (w, i) -> if(w = get({lowered}, i), get({english}, i), {own}))"


def is_lower(field: str) -> bool:
    return field in _LOWER


def tokenize(text: str) -> Column:
    return F.expr(tokenize_sql(text))


def strip_possessive(token: str) -> Column:
    return F.expr(strip_possessive_sql(token))


def mask_stop_words(tokens: str, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    return F.expr(f"transform({tokens}, t -> {mask_stop_word_sql('t', stop_words)})")


def contents_field(case_sensitive: Column, word_stemming: Column) -> Column:
    """The analysed form a dictionary asks for with its two settings."""
    return F.when(
        F.coalesce(case_sensitive, F.lit(False)),
        F.when(word_stemming, F.lit(CASE_SENSITIVE)).otherwise(F.lit(CASE_SENSITIVE_NO_STEM)),
    ).otherwise(F.when(word_stemming, F.lit(ENGLISH)).otherwise(F.lit(NO_STEM)))


def word_pieces(text: str) -> Column:
    """``text`` in lower case, cut at every word boundary."""
    return F.expr(f"regexp_extract_all(lower({text}), {_quote(PIECE)}, 0)")


def word_regex_match(text: Column, term: Column, regex_terms: bool = False) -> Column:
    """Case-insensitive match of ``term`` with word boundaries on both sides."""
    body = term if regex_terms else F.concat(
        F.lit("\\Q"), F.replace(term, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E")
    )
    return F.rlike(text, F.concat(F.lit("(?iU)\\b"), body, F.lit("\\b")))


def case_folded(text: Column) -> Column:
    """``text`` such that two texts a case-insensitive expression takes for one another become equal.

    Characters are compared one by one there, so what depends on a neighbour (a sigma at
    the end of a word, the dot of a capital i) is made alike.
    """
    return F.translate(F.lower(F.upper(text)), "ς\u0307", "σ")


def required_literal(term: str) -> Column:
    """The longest run of plain characters that every match of an expression holds; empty where none is sure.

    Expressions with groups, classes, alternatives, counts or escapes have none here.
    """
    plain = ~F.col(term).rlike(r"[|()\[\]{}\\]")
    runs = F.split(F.regexp_replace(term, r"(?s).[*?][+?]?", "\u0001"), "[\u0001.^$+]")
    longest = F.aggregate(runs, F.lit(""), lambda best, run: F.when(F.length(run) > F.length(best), run).otherwise(best))
    return F.when(plain, longest).otherwise(F.lit(""))

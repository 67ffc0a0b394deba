"""Porter (1980) stemming as native SQL expressions.

The algorithm is a short sequence of steps; each step looks at the end of the
word and rewrites it when the part before the suffix passes a test. A matched
suffix ends the step even when its test fails. Plain suffix comparisons come
first: most words match no suffix, and only the few that do pay for a regular
expression.

A step mentions its input many times, so the steps must not be folded into one
expression: ``stem_sql`` chains one ``transform`` over the array per step, and
within a step ``_let`` binds what only few words need. All is written as SQL text
because one parsed string is built far faster than some thousand column calls.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# A word is [C](VC)^m[V]. A leading "y" is marked so that it counts as a
# consonant; a "y" after a vowel is a consonant by construction.
# Neighbouring runs share no letter, so nothing needs to be tried twice.
_C = "[^aeiou][^aeiouy]*+"
_V = "[aeiouy][aeiou]*+"
_M_POSITIVE = f"^(?:{_C})?+{_V}[^aeiou]"
_M_ONE = f"^(?:{_C})?+{_V}{_C}(?:{_V})?+$"
_M_ABOVE_ONE = f"^(?:{_C})?+{_V}{_C}{_V}[^aeiou]"
_HAS_VOWEL = f"^(?:{_C})?+[aeiouy]"
_CVC = f"^{_C}[aeiouy][^aeiouwxy]$"
_DOUBLE = r"([^aeiouylsz])\1$"

# The published suffix tables of the 1980 paper, with the
# author's later "bli" and "logi" entries.
STEP_2 = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
    ("izer", "ize"), ("bli", "ble"), ("alli", "al"), ("entli", "ent"),
    ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"),
    ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"),
    ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
    ("logi", "log"),
]
STEP_3 = [
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"),
    ("ical", "ic"), ("ful", ""), ("ness", ""),
]
STEP_4 = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment",
    "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
]

# Markers that no word contains: a leading "y" (a consonant) and a word too short
# to be stemmed.
_Y = "\u0002"
_SHORT = "\u0003"


# Every function below takes a word as SQL and gives SQL.


def _ends(word: str, *suffixes: str) -> str:
    return "(" + " OR ".join(f"endswith({word}, '{suffix}')" for suffix in suffixes) + ")"


def _without(word: str, suffix: str) -> str:
    return f"left({word}, length({word}) - {len(suffix)})"


def _like(word: str, pattern: str) -> str:
    return f"{word} RLIKE r'{pattern}'"


def _let(value: str, step: Callable[[str], str]) -> str:
    """``step`` of a computed value, which is computed once."""
    return f"get(transform(array({value}), r -> {step('r')}), 0)"


def _by_suffix(word: str, endings: dict[str, str]) -> str:
    """The value of the longest suffix that ``word`` ends with, else ``word``.

    Suffixes are grouped by their last letter, so that a word which cannot match
    is dismissed after a handful of comparisons.
    """
    groups = []
    for letter in sorted({suffix[-1] for suffix in endings}):
        cases = " ".join(
            f"WHEN {_ends(word, suffix)} THEN {endings[suffix]}"
            for suffix in sorted(endings, key=len, reverse=True)
            if suffix.endswith(letter)
        )
        groups.append(f"WHEN {_ends(word, letter)} THEN CASE {cases} ELSE {word} END")
    return f"CASE {' '.join(groups)} ELSE {word} END"


def _replace_suffixes(word: str, pairs: list[tuple[str, str]]) -> str:
    return _by_suffix(word, {
        suffix: f"if({_like(_without(word, suffix), _M_POSITIVE)}, "
                f"concat({_without(word, suffix)}, '{ending}'), {word})"
        for suffix, ending in pairs
    })


def _drop_suffixes(word: str, suffixes: list[str]) -> str:
    endings = {}
    for suffix in suffixes:
        rest = _without(word, suffix)
        test = _like(rest, _M_ABOVE_ONE)
        if suffix == "ion":
            test = f"{_ends(rest, 's', 't')} AND {test}"
        endings[suffix] = f"if({test}, {rest}, {word})"
    return _by_suffix(word, endings)


def mark(word: str) -> str:
    return (
        f"CASE WHEN length({word}) <= 2 THEN concat({word}, '{_SHORT}') "
        f"WHEN startswith({word}, 'y') THEN concat('{_Y}', substring({word}, 2)) ELSE {word} END"
    )


def _unmark(word: str) -> str:
    return (
        f"CASE WHEN {_ends(word, _SHORT)} THEN {_without(word, _SHORT)} "
        f"WHEN startswith({word}, '{_Y}') THEN concat('y', substring({word}, 2)) ELSE {word} END"
    )


def _repair(word: str) -> str:
    """What becomes of a word that has just lost "ed" or "ing"."""
    return (
        f"CASE WHEN {_ends(word, 'at', 'bl', 'iz')} THEN concat({word}, 'e') "
        f"WHEN {_like(word, _DOUBLE)} THEN left({word}, length({word}) - 1) "
        f"WHEN {_like(word, _CVC)} THEN concat({word}, 'e') ELSE {word} END"
    )


def _past(word: str) -> str:
    def cut(suffix: str) -> str:
        rest = _without(word, suffix)
        return f"if({_like(rest, _HAS_VOWEL)}, {_let(rest, _repair)}, {word})"

    agreed = f"if({_like(_without(word, 'eed'), _M_POSITIVE)}, {_without(word, 'd')}, {word})"
    return (
        f"CASE WHEN {_ends(word, 'd')} THEN "
        f"CASE WHEN {_ends(word, 'eed')} THEN {agreed} WHEN {_ends(word, 'ed')} THEN {cut('ed')} ELSE {word} END "
        f"WHEN {_ends(word, 'ing')} THEN {cut('ing')} ELSE {word} END"
    )


def _step_1(word: str) -> str:
    singular = (
        f"CASE WHEN {_ends(word, 'ss')} THEN {word} "
        f"WHEN {_ends(word, 'sses', 'ies')} THEN {_without(word, 'es')} ELSE {_without(word, 's')} END"
    )
    return f"if({_ends(word, 's')}, {_let(singular, _past)}, {_past(word)})"


def _step_2(word: str) -> str:
    rest = _without(word, "y")
    with_i = f"if({_like(rest, _HAS_VOWEL)}, concat({rest}, 'i'), {word})"

    def step(stem_: str) -> str:
        return _replace_suffixes(stem_, STEP_2)

    return f"if({_ends(word, 'y')}, {_let(with_i, step)}, {step(word)})"


def _step_5(word: str) -> str:
    rest = _without(word, "e")
    without_e = (
        f"if({_like(rest, _M_ABOVE_ONE)} OR ({_like(rest, _M_ONE)} AND NOT {_like(rest, _CVC)}), {rest}, {word})"
    )

    def double_l(stem_: str) -> str:
        return f"if({_ends(stem_, 'll')} AND {_like(stem_, _M_ABOVE_ONE)}, {_without(stem_, 'l')}, {stem_})"

    return _let(f"if({_ends(word, 'e')}, {_let(without_e, double_l)}, {double_l(word)})", _unmark)


_STEPS = [
    _step_1,
    _step_2,
    lambda word: _replace_suffixes(word, STEP_3),
    lambda word: _drop_suffixes(word, STEP_4),
    _step_5,
]


def stem_marked_sql(tokens: str) -> str:
    """SQL that stems every word of an array of marked words; nulls stay null."""
    for step in _STEPS:
        tokens = f"transform({tokens}, w -> {step('w')})"
    return tokens


def stem_sql(tokens: str) -> str:
    """SQL that stems every word of the array ``tokens``; nulls stay null."""
    return stem_marked_sql(f"transform({tokens}, w -> {mark('w')})")


def kept_start(stem_: str) -> str:
    """SQL for the beginning that a stem shares with every word it is the stem of, possessives included.

    A suffix is cut or rewritten behind two characters at least, but for a last "y" that
    becomes an "i" and for words of which one character is left.
    """
    return f"left({stem_}, if(length({stem_}) = 2 AND endswith({stem_}, 'i'), 1, 2))"


def stem(word: str) -> Column:
    """Stem one word, given as SQL."""
    return F.expr(f"get({stem_sql(f'array({word})')}, 0)")

"""Pseudonyms for personal data that keep its format: Feistel permutations under a key.

Numbers and dates are found by pattern, validated, and permuted among the values of
their own format, so a value has the same pseudonym in every document and two values
never share one. All of it is built-in functions: the text is split at the matches,
each match is permuted, and the pieces are joined again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
#: What is looked for; the order decides where two could begin at one place.
FORMATS = {
    # 64 characters before the sign, and 127 labels of 63 after it, are what a mail address may have
    "email": r"[\p{L}0-9][\p{L}0-9._%+-]{0,63}+@(?:[A-Za-z0-9-]{1,63}+\.){1,126}[A-Za-z]{2,63}+",
    # a date or address may be the first of a range, but no part of a longer number in its own notation
    "date": r"(?:\d{4}-\d{2}-\d{2}(?!\d|-\d(?!\d{3}-\d{2}-\d{2}(?!\d)))|\d{2}\.\d{2}\.\d{4}(?!\.?\d)|\d{2}/\d{2}/\d{4}(?!/?\d))",
    "ip": r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\.?\d)",
    "phone": r"(?:\+\d{1,3}[ .-]?\(?\d{2,4}\)?[ .-]?\d{3,4}[ .-]?\d{3,4}|\+\d{1,3}[ .-]\d{1,3}(?:[ .-]\d{2}){3,4}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}-\d{3}-\d{4}|\d{3}\.\d{3}\.\d{4})(?!\d)",
    "ssn": r"\d{3}-\d{2}-\d{4}(?!-?\d)",
    # what stands in quotes after a name that says what it is; most quotes fail at the first look behind them
    "token": r"(?<=[\"'])(?<=(?i:token|key|secret|password)[\"']?\s{0,3}[=:]\s{0,3}[\"'])[A-Za-z0-9_+/=-]{16,}+(?=[\"'])|AKIA[A-Z0-9]{16}(?![A-Za-z0-9])",
}
#: Cards as they are written: digits in groups with one kind of separator, then unbroken ones. No run of groups is ever tried twice, so none is too long.
OTHERS = "|".join(FORMATS[k] for k in ("date", "ip", "phone", "ssn"))
FOUR = r"\d{4}(?:SEP(?!OTHER|\d{4}SEP\d{6}SEP\d{4,5}(?!\d))\d{4}(?!\d))"
FOURS = "|".join(rf"{FOUR}{{3,}}+(?:SEP(?!OTHER)\d{{3}}(?!\d))?".replace("SEP", sep) for sep in " -").replace("OTHER", OTHERS)
PARTED = "|".join(r"\d{4}SEP\d{6}SEP\d{4,5}(?!\d)|\d{6}SEP\d{13}(?!\d)".replace("SEP", sep) for sep in " -")
GROUPED = rf"{PARTED}|{FOURS}|\d{{13,19}}(?!\d)"
#: Whether one begins here; four groups are enough to tell.
BEGINS = rf"{PARTED}|" + "|".join(rf"{FOUR}{{3}}".replace("SEP", sep) for sep in " -").replace("OTHER", OTHERS) + r"|\d{13,19}(?!\d)"
#: Other long numbers end before a date, an address or a card as above.
FORMATS["card"] = rf"(?:{GROUPED}|\d(?:(?:[ -](?!{BEGINS}|{OTHERS}))?\d){{12,18}}(?!\d))"
#: A number begins after no letter or digit, and after a sign only where that does not go on a number; a range's end may follow its start.
BEGIN = r"(?=[\d+(])(?:(?<![A-Za-z0-9])(?<!\d[._+-])|(?<=(?<!\d)(?:\d{4}-\d{2}-\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4}|\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})-))"
#: A mail address begins where none of its own characters could have begun it before.
MAIL_BEGIN = r"(?<![\p{L}0-9])(?<![\p{L}0-9][._%+-])"
PATTERN = f"{MAIL_BEGIN}{FORMATS['email']}|{BEGIN}(?:" + "|".join(p for k, p in FORMATS.items() if k not in ("email", "token")) + ")|" + FORMATS["token"]
#: The Gregorian calendar repeats after 400 years; dates in one such span are permuted as two digits of these bases.
DATE_FROM, DATE_HIGH, DATE_LOW = "1800-01-01", 189, 773


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value computed once, however often it is read and in whatever loop."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def mac(key: str, *parts: Column) -> Column:
    """52 bits of a keyed digest, as a long."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(key), *(p.cast("string") for p in parts)), 256), 1, 13), 16, 10).cast("long")


def feistel(high: Column, low: Column, bases: tuple[Column, Column], key: str, tag: Column) -> Column:
    """A keyed permutation of pairs (high, low) below bases: each round adds a digest of one half to the other."""
    state = F.struct(high.cast("long").alias("h"), low.cast("long").alias("l"))
    for i in range(ROUNDS):
        # a fold over one turn keeps the expression from doubling with every round
        state = F.aggregate(F.array(F.lit(i)), state, _high_turn(bases[0], key, tag) if i % 2 == 0 else _low_turn(bases[1], key, tag))
    return state


def _high_turn(base: Column, key: str, tag: Column):
    return lambda s, turn: F.struct(F.pmod(s["h"] + mac(key, tag, turn, s["l"]), base).alias("h"), s["l"].alias("l"))


def _low_turn(base: Column, key: str, tag: Column):
    return lambda s, turn: F.struct(s["h"].alias("h"), F.pmod(s["l"] + mac(key, tag, turn, s["h"]), base).alias("l"))


def permuted_digits(digits: Column, key: str, tag: str) -> Column:
    """Digits permuted among all strings of as many digits; one alone stays among the ten."""
    return let(digits, lambda d: _permuted_digits(d, key, tag))


def _permuted_digits(digits: Column, key: str, tag: str) -> Column:
    n = F.length(digits)
    left = F.floor(n / 2).cast("int")
    high, low = F.substring(digits, F.lit(1), left), F.substring(digits, left + 1, n)
    bases = (F.pow(F.lit(10.0), left).cast("long"), F.pow(F.lit(10.0), n - left).cast("long"))
    out = feistel(F.coalesce(F.when(left > 0, high).cast("long"), F.lit(0)), low.cast("long"), bases, key, F.concat(F.lit(tag), n.cast("string")))
    return let(out, lambda o: F.concat(
        F.when(left > 0, F.lpad(o["h"].cast("string"), left, "0")).otherwise(F.lit("")), F.lpad(o["l"].cast("string"), n - left, "0")))


def luhn_sum(digits: Column, shift: int) -> Column:
    """The weighted digit sum; with shift 0 the last digit counts single, with shift 1 double."""
    n = F.length(digits)
    values = F.transform(F.split(digits, ""), lambda d: d.cast("int"))
    return F.aggregate(
        F.transform(values, lambda d, i: F.when((n - i + shift) % 2 == 1, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))), F.lit(0), lambda a, b: a + b)


def refill(shape: Column, digits: Column) -> Column:
    """shape with its digits replaced, one after the other, by those of `digits`."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("used"))

    def filled(new: Column) -> Column:
        def put(s: Column, c: Column) -> Column:
            digit = c.rlike("^[0-9]$")
            return F.struct(
                F.concat(s["out"], F.when(digit, F.substring(new, s["used"] + 1, F.lit(1))).otherwise(c)).alias("out"),
                (s["used"] + digit.cast("int")).alias("used"))

        return F.aggregate(F.split(shape, ""), start, put)["out"]

    return let(digits, filled)


def permuted_date(text: Column, key: str) -> tuple[Column, Column]:
    """(whether it is a date of the span, its pseudonym in the same notation)."""
    iso = F.when(text.contains("-"), text).when(
        text.contains("."), F.concat_ws("-", F.substring(text, 7, 4), F.substring(text, 4, 2), F.substring(text, 1, 2))).otherwise(
        F.concat_ws("-", F.substring(text, 7, 4), F.substring(text, 1, 2), F.substring(text, 4, 2)))
    day = F.datediff(F.try_to_date(iso, "yyyy-MM-dd"), F.lit(DATE_FROM).cast("date"))
    valid = day.between(0, DATE_HIGH * DATE_LOW - 1)
    out = feistel(F.floor(day / DATE_LOW), F.pmod(day, F.lit(DATE_LOW)), (F.lit(DATE_HIGH).cast("long"), F.lit(DATE_LOW).cast("long")), key, F.lit("date"))
    new = let(out, lambda o: F.date_add(F.lit(DATE_FROM).cast("date"), (o["h"] * DATE_LOW + o["l"]).cast("int")))
    form = F.when(text.contains("-"), "yyyy-MM-dd").when(text.contains("."), "dd.MM.yyyy").otherwise("MM/dd/yyyy")
    shown = F.call_function("date_format", new, form)
    return F.coalesce(valid, F.lit(False)), shown


def permuted_ip(text: Column, key: str) -> tuple[Column, Column]:
    """(whether all parts are bytes, the pseudonym): the four bytes are two halves of 16 bits."""
    parts = F.transform(F.split(text, r"\."), lambda p: p.cast("int"))
    valid = F.forall(parts, lambda p: p <= 255)
    base = F.lit(65536).cast("long")
    out = feistel(parts[0] * 256 + parts[1], parts[2] * 256 + parts[3], (base, base), key, F.lit("ip"))
    shown = let(out, lambda o: F.concat_ws(".", *(F.floor(o[x] / 256).cast("string") if k == 0 else F.pmod(o[x], F.lit(256)).cast("string") for x in ("h", "l") for k in (0, 1))))
    return valid, shown


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), an array, with value computed once however often it is read."""
    return F.flatten(F.transform(F.array(value), use))


#: Groups that are taken at a time: what is put together so far is copied once per run, not once per group.
RUN = 64


def parts_of(match: Column) -> Column:
    """A match as pieces: of a row of groups in which several cards could begin, those that pass the Luhn test.

    Where none does, four groups are a number. What is left of the row stands alone and is no card.
    """
    groups, sep = F.regexp_extract_all(match, F.lit(r"\d+"), F.lit(0)), F.regexp_extract(match, "[ -]", 0)
    digits = F.regexp_replace(match, "[ -]", "")
    row = bound(F.struct(groups.alias("groups"), sep.alias("sep"), F.size(F.filter(groups, lambda g: F.length(g) == 4)).alias("four")),
                lambda r: bound(F.struct(r["groups"].alias("groups"), r["sep"].alias("sep"), r["four"].alias("four"), _cards(r).alias("cards")), _row_pieces))
    many = match.rlike(r"^\d{4}(?:[ -]\d{4}){4}") | match.rlike(r"^\d{4}(?:[ -]\d{4}){3}[ -]\d{3}$")
    return F.when(many & match.rlike(f"^(?:{FOURS})$"), row).when(
        match.rlike(r"^\d{6}[ -]\d{13}$") & (luhn_sum(digits, 0) % 10 != 0), F.array(F.get(groups, F.lit(0)), sep, F.get(groups, F.lit(1)))).otherwise(F.array(match))


def _cards(row: Column) -> Column:
    """How many groups a card that begins at each group has, else 0; the fifth is a short one."""
    size = F.size(row["groups"])

    def passes(start: Column, n: int) -> Column:
        return (start + n <= size) & (luhn_sum(F.array_join(F.slice(row["groups"], start + 1, F.lit(n)), ""), 0) % 10 == 0)

    return F.transform(row["groups"], lambda g, i: F.when((i + 4 <= row["four"]) & passes(i, 4), 4).when(
        (i + 5 == size) & (i + 4 == row["four"]) & passes(i, 5), 5).otherwise(0))


def _row_pieces(row: Column) -> Column:
    groups, sep, four, cards = (row[c] for c in ("groups", "sep", "four", "cards"))
    last = F.size(groups) - 1

    def put(s: Column, i: Column) -> Column:
        soon = F.exists(F.slice(cards, i + 2, F.lit(3)), lambda n: n > 0)
        n = F.when(F.get(cards, i) > 0, F.get(cards, i)).when(~soon & (i + 4 <= four), 4).otherwise(1)
        piece = F.array(F.call_function("array_join", F.slice(groups, i + 1, n), sep), F.when(i + n <= last, sep).otherwise(F.lit("")))
        return F.when(i < s["until"], s).otherwise(F.struct(F.concat(s["out"], piece).alias("out"), (i + n).alias("until")))

    def run(s: Column, k: Column) -> Column:
        start = F.struct(F.array().cast("array<string>").alias("out"), s["until"].alias("until"))
        own = F.aggregate(F.sequence(k * RUN, F.least(k * RUN + RUN - 1, last)), start, put)
        return F.get(F.transform(F.array(own), lambda r: F.struct(F.concat(s["out"], F.array(r["out"])).alias("out"), r["until"].alias("until"))), F.lit(0))

    begin = F.struct(F.array().cast("array<array<string>>").alias("out"), F.lit(0).alias("until"))
    return F.flatten(F.aggregate(F.sequence(F.lit(0), F.floor(last / RUN).cast("int")), begin, run)["out"])


def pseudonym(match: Column, key: str) -> Column:
    """(kind, value) of a match; a match that is not valid keeps its text and has no kind."""
    digits = F.regexp_replace(match, "[^0-9]", "")
    body = F.substring(digits, F.lit(1), F.length(digits) - 1)
    new_card = let(permuted_digits(body, key, "card"), lambda new: F.concat(new, F.pmod(10 - luhn_sum(new, 1) % 10, F.lit(10)).cast("string")))
    card_shape = match.rlike("^" + FORMATS["card"] + "$")
    luhn = luhn_sum(digits, 0) % 10 == 0
    date_shape, ip_shape = match.rlike("^" + FORMATS["date"] + "$"), match.rlike("^" + FORMATS["ip"] + "$")
    date_valid, date_new = permuted_date(match, key)
    ip_valid, ip_new = permuted_ip(match, key)
    ssn_shape = match.rlike("^" + FORMATS["ssn"] + "$")
    phone_shape = match.rlike("^" + FORMATS["phone"] + "$")
    name = F.substring_index(match, "@", 1)
    code = F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit("text"), match), 256), 1, 20)
    cases = [
        ("email", match.contains("@"), F.concat(F.lit("user-"), F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit("mail"), F.lower(match)), 256), 1, 16), F.lit("@example.invalid"))),
        ("date", date_shape & date_valid, date_new),
        ("ip", ip_shape & ip_valid, ip_new),
        ("phone", phone_shape, refill(match, permuted_digits(digits, key, "phone"))),
        ("ssn", ssn_shape, refill(match, permuted_digits(digits, key, "ssn"))),
        ("card", card_shape & luhn, refill(match, new_card)),
        ("number", card_shape, refill(match, permuted_digits(digits, key, "number"))),
        ("token", ~date_shape & ~ip_shape & (F.length(match) >= 16) & name.isNotNull(), code),
    ]
    kind, value = F.lit(None).cast("string"), match
    for k, when, new in reversed(cases):
        kind, value = F.when(when, F.lit(k)).otherwise(kind), F.when(when, new).otherwise(value)
    return F.struct(kind.alias("kind"), value.alias("value"))


def pseudonymise(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, text with pseudonyms, n_found, kinds (sorted, distinct).

    Card numbers pass the Luhn test before and after; long numbers that fail it are
    permuted among all numbers of their length; dates stay dates of 1800 to 2199 in
    their notation, addresses stay addresses; telephone and social security numbers
    keep their punctuation. A card is told from numbers, dates and addresses beside it by
    its groups and the Luhn test. Mail addresses and secret tokens, which have no number
    format, become keyed digests. A match that is not valid in its format stays. Equal
    values have equal pseudonyms in all documents, however long their texts. Null text
    gives null text and none found; an empty text stays empty; repeated rows are treated
    alike; an empty table gives no rows; other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = rows.withColumn("found", F.coalesce(F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0)), F.array().cast("array<string>")))
    # only texts with a match are split
    some = F.size("found") > 0
    made = found.withColumn("made", F.when(some, F.transform("found", lambda m: F.transform(parts_of(m), lambda p: pseudonym(p, key))))).withColumn("between", F.when(some, F.split("text", PATTERN, -1)))
    joined = F.array_join(F.transform("between", lambda part, i: F.concat(part, F.coalesce(F.array_join(F.get("made", i)["value"], ""), F.lit("")))), "")
    kinds = F.filter(F.transform(F.flatten("made"), lambda m: m["kind"]), lambda k: k.isNotNull())
    return made.select(
        "doc_id", F.when(some, joined).otherwise(F.col("text")).alias("text"),
        F.coalesce(F.size(kinds), F.lit(0)).cast("long").alias("n_found"),
        F.coalesce(F.array_join(F.array_sort(F.array_distinct(kinds)), ","), F.lit("")).alias("kinds"))

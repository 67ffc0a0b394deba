"""Dictionary by corpus phrase join.

All phrases are found in one pass over the text. Each analysed phrase has a
*lead* (its first word), *offsets* of its words relative to the lead (holes left
by stop words are skipped) and a *gram*, which spells offsets and words as one
string. A document position is kept only if its word is some phrase's lead; for
the offsets known for that lead the document's own gram is built and looked up.
The lookup is an equality on the whole phrase, so phrases that share a frequent
lead do not multiply candidates.

While the phrases fit a checked broadcast, text never moves: only matched
(document, gram) counts are shuffled. Beyond it hashed sets of leads and grams, of
fixed size, are broadcast instead. They pass few positions that match nothing, and
these and the matches meet the grams in a salted shuffle join; every shape is tried
at every lead, as the shapes are few even where phrases are many. Only with more
than ``MAX_SHAPES`` of them leads are joined by shuffle as well.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from termloom.functions import text as T
from termloom.functions.stemmer import kept_start
from termloom.operators.bounds import fits_broadcast, key_bitmaps, maybe_among, salted_join, spread
from termloom.sources.scratch import scratch_path, settle

SEPARATOR = "\u0001"

# Shapes that are tried at every lead of a text.
MAX_SHAPES = 512

# Up to so many shapes are spelled out in the plan, as bits of a number for each lead.
SPELLED_SHAPES = 24

# Up to so many beginnings of stems are spelled out in the plan; a field with more stems all words.
SPELLED_STARTS = 256


def analyze_documents(
    docs: DataFrame,
    fields: Sequence[str],
    ids: Sequence[str] = ("docid",),
    text: str = "contents",
    stop_words: Sequence[str] = T.STOP_WORDS,
    keep_words: bool = False,
    reused: bool = False,
    carried: Sequence[str] = (),
    starts: Mapping[str, Sequence[str]] | None = None,
    placed: bool = False,
) -> DataFrame:
    """(ids, carried, field, toks): the searchable tokens of each document and field.

    The result may be written to a table and matched many times. With
    ``keep_words`` the plain words are kept next to the tokens. With the ``starts`` of
    compiled phrases only words that these can hold are stemmed; the tokens then serve
    those phrases only.

    A small input is spread by ``ids``, so that counting needs no shuffle of its
    own. With ``reused`` it is spread in a way that does not say so: the counts
    are then shuffled once and both of their readers share that shuffle. With ``placed``
    every text stays in the task that it is in.
    """
    keys = [F.xxhash64(*ids)] if reused else ids
    docs = docs.select(*ids, *carried, F.col(text).alias("_text"))
    for name in ids:
        docs = docs.where(F.col(name).isNotNull())
    docs = docs if placed else spread(docs, *keys)
    lower_only = all(T.is_lower(field) for field in fields) and not keep_words
    source = "lower(_text)" if lower_only else "_text"
    docs = docs.select(*ids, *carried, T.tokenize(source).alias("words"))
    lowered = "words"
    if not lower_only and any(T.is_lower(field) for field in fields):
        docs = docs.withColumn("lowered", F.expr(T.lower_tokens_sql("words")))
        lowered = "lowered"
    carried = [*carried, "words"] if keep_words else carried
    starts = starts or {}
    known = {}
    if T.STEMMED.issubset(fields):
        # Most words are in lower case, and have the same stem in both forms.
        begun = [starts.get(field) for field in T.STEMMED]
        both = None if None in begun else sorted(set().union(*begun))
        docs = docs.withColumn("_english", F.expr(T.searchable_sql(T.ENGLISH, "words", lowered, stop_words, both)))
        own = T.case_sensitive_sql("words", lowered, "_english", stop_words, both)
        known = {T.ENGLISH: "_english", T.CASE_SENSITIVE: own}
    forms = [
        (field, known.get(field) or T.searchable_sql(field, "words", lowered, stop_words, starts.get(field)))
        for field in fields
    ]
    if len(forms) == 1:
        field, toks = forms[0]
        return docs.select(*ids, *carried, F.lit(field).alias("field"), F.expr(toks).alias("toks"))
    return docs.select(
        *ids, *carried,
        F.inline(F.array(*[F.struct(F.lit(f).alias("field"), F.expr(t).alias("toks")) for f, t in forms])),
    )


@dataclass(frozen=True)
class Phrases:
    """Compiled phrases, written once, and what was counted about them."""

    rows: DataFrame
    fields: list[str]
    longest: int
    small: bool
    few_shapes: bool = True
    number: int = 0
    path: str | None = None
    shapes: tuple[str, ...] | None = None
    starts: dict[str, tuple[str, ...]] | None = None


def compile_phrases(phrases: DataFrame, tokens: Column, broadcast_bytes: int | None = None) -> Phrases:
    """Add lead, offsets, span, shape and gram; phrases without words are dropped."""
    places = F.filter(
        F.transform("_toks", lambda tok, i: F.when(tok.isNotNull(), i)), lambda i: i.isNotNull()
    )
    first = F.get("_at", F.lit(0))
    offsets = F.transform("_at", lambda i: i - first)
    kept = [F.col(name) for name in phrases.columns]
    rows = (
        phrases.select(*kept, tokens.alias("_toks"))
        .select(*kept, "_toks", places.alias("_at"))
        .where(F.size("_at") > 0)
        .select(*kept, "_toks", offsets.alias("offsets"), F.get("_toks", first).alias("lead"))
        .select(
            *kept, "lead", "offsets",
            (F.try_element_at("offsets", F.lit(-1)) + 1).alias("span"),
            F.array_join(F.transform("offsets", lambda o: o.cast("string")), ",").alias("shape"),
            F.array_join("_toks", SEPARATOR).alias("_words"),
        )
        .select(*kept, "lead", "offsets", "span", "shape", F.concat_ws(SEPARATOR, "shape", "_words").alias("gram"))
    )
    # Counted while the rows are written: whatever a join may broadcast is part
    # of a row, so the rows' own size bounds it.
    seen = Observation()
    path = scratch_path(phrases.sparkSession, "settled")
    rows = settle(
        rows.observe(
            seen,
            F.count(F.lit(1)).alias("rows"),
            F.sum(F.octet_length(F.to_json(F.struct("*"))) + 64).alias("bytes"),
            F.max("span").alias("longest"),
            *[F.count_if(F.col("field") == name).alias(name) for name in T.FIELDS],
        ),
        path,
    )
    found = seen.get
    small = fits_broadcast(found["rows"], found["bytes"] or 0, broadcast_bytes)
    few_shapes, spelled, starts = True, None, {}
    if small:
        some = [row["shape"] for row in rows.select("shape").distinct().limit(SPELLED_SHAPES + 1).collect()]
        spelled = tuple(sorted(some)) if len(some) <= SPELLED_SHAPES else None
        starts = _starts(rows, [name for name in T.FIELDS if found[name] and name in T.STEMMED])
    else:
        shapes = rows.select("field", "shape").distinct().agg(
            F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("shape") + 64).alias("bytes")
        ).first()
        few_shapes = shapes["rows"] <= MAX_SHAPES and fits_broadcast(shapes["rows"], 8 * (shapes["bytes"] or 0))
    return Phrases(
        rows,
        fields=[name for name in T.FIELDS if found[name]],
        longest=found["longest"] or 1,
        small=small,
        few_shapes=few_shapes,
        number=found["rows"],
        path=path,
        shapes=spelled,
        starts=starts,
    )


def _starts(rows: DataFrame, fields: Sequence[str]) -> dict[str, tuple[str, ...]]:
    """How the words of compiled phrases begin, for stemmed fields in which they begin in few ways."""
    if not fields:
        return {}
    words = rows.where(F.col("field").isin(*fields)).select(
        "field", F.explode(F.slice(F.split("gram", SEPARATOR), 2, F.size("offsets"))).alias("word")
    )
    begun = words.select("field", F.expr(kept_start("word")).alias("start")).distinct()
    some = begun.limit(len(fields) * SPELLED_STARTS + 1).collect()
    if len(some) > len(fields) * SPELLED_STARTS:
        return {}
    return {field: tuple(sorted(row["start"] for row in some if row["field"] == field)) for field in fields}


def compile_terms(
    terms: DataFrame,
    term: str = "term",
    fields: Sequence[str] = T.FIELDS,
    stop_words: Sequence[str] = T.STOP_WORDS,
    broadcast_bytes: int | None = None,
) -> Phrases:
    """Compile ``term`` with the analyser named by the row's ``field``."""
    return compile_phrases(terms, T.analyze_by_field("field", term, fields, stop_words), broadcast_bytes)


def find_phrases(
    analyzed: DataFrame,
    phrases: Phrases,
    ids: Sequence[str] = ("docid",),
    context: int | None = None,
) -> DataFrame:
    """(ids, field, gram, pos) for every position where a phrase starts.

    With ``context`` the plain words from ``context`` words before to
    ``context`` words after the match come along as ``snippet``. The rows are
    the same whether the phrases are broadcast or not.
    """
    if phrases.shapes and context is None:
        return _find_spelled(analyzed, phrases, ids)
    by_lead = phrases.small or not phrases.few_shapes
    keys = ["field", "lead"] if by_lead else ["field"]
    leads = phrases.rows.groupBy(*keys).agg(
        F.collect_set(F.struct("shape", "offsets")).alias("shapes"),
        F.max("span").alias("lead_span"),
    )
    around = 0 if context is None else context
    before = F.greatest(F.col("pos") - around, F.lit(0))

    def near(span: Column) -> list[Column]:
        if context is None:
            return []
        return [F.slice("words", before + 1, F.col("pos") - before + span + around).alias("words")]

    words = [] if context is None else ["words"]
    # The outer form keeps Catalyst from testing the array first, which would
    # tokenize every text a second time; the joins drop its extra null rows.
    placed = analyzed.select(*ids, "field", "toks", *words, F.posexplode_outer("toks").alias("pos", "lead"))
    # Only slices travel past a join: a copy of the whole array per position
    # would be quadratic in the length of a document.
    if not phrases.small:
        known = phrases.rows.select("field", "lead").distinct()
        placed = maybe_among(placed.where(F.col("lead").isNotNull()), known, ["field", "lead"])
    if phrases.small or phrases.few_shapes:
        tried = placed.join(F.broadcast(leads), keys).select(
            *ids, "field", "pos", *near(F.col("lead_span")),
            F.slice("toks", F.col("pos") + 1, F.col("lead_span")).alias("toks"), "shapes",
        )
    else:
        longest = F.lit(phrases.longest)
        placed = placed.select(
            *ids, "field", "lead", "pos", *near(longest),
            F.slice("toks", F.col("pos") + 1, longest).alias("toks"),
        )
        tried = salted_join(placed, leads, keys, [*ids, "pos"])
    tried = tried.select(*ids, "field", "pos", *words, "toks", F.explode("shapes").alias("shape"))
    own = F.array_join(F.transform("shape.offsets", lambda o: F.get("toks", o)), SEPARATOR)
    gram = F.concat_ws(SEPARATOR, F.col("shape.shape"), own).alias("gram")
    length = F.col("pos") - before + F.try_element_at("shape.offsets", F.lit(-1)) + 1 + around
    snippet = [] if context is None else [
        F.array_join(F.slice("words", F.lit(1), length), " ").alias("snippet")
    ]
    found = tried.select(*ids, "field", "pos", gram, *snippet)
    grams = phrases.rows.select("field", "gram").distinct()
    if phrases.small:
        return found.join(F.broadcast(grams), ["field", "gram"], "left_semi")
    found = maybe_among(found, grams, ["field", "gram"])
    return salted_join(found, grams, ["field", "gram"], [*ids, "pos"], "left_semi")


@dataclass(frozen=True)
class Wanted:
    """Hashed sets of the leads and grams of some phrases, written once, and their shapes, spelled if they are few."""

    leads: DataFrame
    grams: DataFrame
    shapes: DataFrame
    spelled: tuple[str, ...] | None


def wanted(rows: DataFrame) -> Wanted:
    """Of the compiled ``rows``, which have ``MAX_SHAPES`` at most."""
    shapes = settle(
        rows.groupBy("field").agg(
            F.collect_set(F.struct("shape", "offsets")).alias("shapes"), F.max("span").alias("lead_span")
        )
    )
    some = shapes.select(F.explode("shapes.shape").alias("shape")).distinct().limit(SPELLED_SHAPES + 1).collect()
    return Wanted(
        settle(key_bitmaps(rows, ["field", "lead"])),
        settle(key_bitmaps(rows, ["field", "gram"])),
        shapes,
        tuple(sorted(row["shape"] for row in some)) if len(some) <= SPELLED_SHAPES else None,
    )


def find_candidates(analyzed: DataFrame, some: Wanted, ids: Sequence[str] = ("docid",)) -> DataFrame:
    """(ids, field, gram) for every position where one of some phrases starts, and for a few where none does.

    Nothing is shuffled. An equi-join on field and gram leaves what ``find_phrases`` finds.
    """
    # The outer form as in find_phrases.
    placed = analyzed.select(*ids, "field", "toks", F.posexplode_outer("toks").alias("pos", "lead"))
    placed = maybe_among(placed.where(F.col("lead").isNotNull()), None, ["field", "lead"], some.leads)
    if some.spelled:
        found = placed.select(*ids, "field", F.explode(F.array(*map(_gram_at, some.spelled))).alias("gram"))
    else:
        tried = placed.join(F.broadcast(some.shapes), "field").select(
            *ids, "field", F.slice("toks", F.col("pos") + 1, F.col("lead_span")).alias("toks"), "shapes"
        )
        found = _try_shapes(tried, ids)
    return maybe_among(found, None, ["field", "gram"], some.grams)


def _try_shapes(tried: DataFrame, ids: Sequence[str]) -> DataFrame:
    tried = tried.select(*ids, "field", "toks", F.explode("shapes").alias("shape"))
    own = F.array_join(F.transform("shape.offsets", lambda o: F.get("toks", o)), SEPARATOR)
    return tried.select(*ids, "field", F.concat_ws(SEPARATOR, F.col("shape.shape"), own).alias("gram"))


def _gram_at(shape: str) -> Column:
    """The gram of a position, whose first word is there."""
    words = [F.col("lead"), *(F.get("toks", F.col("pos") + int(offset)) for offset in shape.split(",")[1:])]
    return F.concat_ws(SEPARATOR, F.lit(shape), *words)


def _find_spelled(analyzed: DataFrame, phrases: Phrases, ids: Sequence[str]) -> DataFrame:
    """``find_phrases`` for few shapes: the grams of a position are plain expressions, built in one pass."""
    bit = F.lit(0)
    for k, shape in enumerate(phrases.shapes):
        bit = F.when(F.col("shape") == shape, 1 << k).otherwise(bit)
    leads = phrases.rows.groupBy("field", "lead").agg(F.bit_or(bit).alias("mask"))
    # The outer form keeps Catalyst from testing the array first, which would
    # tokenize every text a second time; the join drops its extra null rows.
    placed = analyzed.select(*ids, "field", "toks", F.posexplode_outer("toks").alias("pos", "lead"))
    tried = placed.join(F.broadcast(leads), ["field", "lead"])
    grams = []
    for k, shape in enumerate(phrases.shapes):
        grams.append(F.when(F.col("mask").bitwiseAND(1 << k) != 0, _gram_at(shape)))
    if len(grams) == 1:
        found = tried.select(*ids, "field", "pos", grams[0].alias("gram"))
    else:
        found = tried.select(*ids, "field", "pos", F.explode(F.array(*grams)).alias("gram"))
    known = phrases.rows.select("field", "gram").distinct()
    return found.join(F.broadcast(known), ["field", "gram"], "left_semi")


def count_phrases(analyzed: DataFrame, phrases: Phrases, ids: Sequence[str] = ("docid",)) -> DataFrame:
    """(ids, field, gram, hits): how often each phrase starts in each document."""
    found = find_phrases(analyzed, phrases, ids)
    return found.groupBy(*ids, "field", "gram").agg(F.count("*").cast("int").alias("hits"))


def attach_terms(
    found: DataFrame, terms: DataFrame, phrases: Phrases, salt_from: Sequence[str] = ("docid",)
) -> DataFrame:
    """Join grams to every row of ``terms`` that spells them."""
    if phrases.small:
        return found.join(F.broadcast(terms), ["field", "gram"])
    return salted_join(found, terms, ["field", "gram"], salt_from)


def highlight_snippets(
    docs: DataFrame,
    terms: DataFrame,
    field: str = T.ENGLISH,
    context: int = 0,
    ids: Sequence[str] = ("docid",),
    text: str = "contents",
) -> DataFrame:
    """(term, ids, start, snippet) for every match; ``start`` counts words from 1."""
    phrases = compile_terms(terms.select("term", F.lit(field).alias("field")).distinct(), fields=[field])
    analyzed = analyze_documents(docs, [field], ids, text, keep_words=True)
    found = find_phrases(analyzed, phrases, ids, context)
    rows = attach_terms(found, phrases.rows.select("field", "gram", "term"), phrases, [*ids, "pos"])
    return rows.select("term", *ids, (F.col("pos") + 1).alias("start"), "snippet")

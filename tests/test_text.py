from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from termloom.functions import strings as S
from termloom.functions import text as T
from termloom.functions.stemmer import stem

# The worked examples of Porter (1980).
STEMS = """
caresses caress ponies poni ties ti caress caress cats cat feed feed agreed agre
plastered plaster bled bled motoring motor sing sing conflated conflat troubled troubl
sized size hopping hop tanned tan falling fall hissing hiss fizzed fizz failing fail
filing file happy happi sky sky relational relat conditional condit rational ration
valenci valenc hesitanci hesit digitizer digit conformabli conform radicalli radic
differentli differ vileli vile analogousli analog vietnamization vietnam predication predic
operator oper feudalism feudal decisiveness decis hopefulness hope callousness callous
formaliti formal sensitiviti sensit sensibiliti sensibl triplicate triplic formative form
formalize formal electriciti electr electrical electr hopeful hope goodness good
revival reviv allowance allow inference infer airliner airlin gyroscopic gyroscop
adjustable adjust defensible defens irritant irrit replacement replac adjustment adjust
dependent depend adoption adopt homologou homolog communism commun activate activ
angulariti angular homologous homolog effective effect bowdlerize bowdler probate probat
rate rate cease ceas controll control roll roll
""".split()


def one(spark, text, expression):
    return spark.createDataFrame([(text,)], "t string").select(expression.alias("x")).first()[0]


def test_stemmer_examples(spark):
    pairs = list(zip(STEMS[::2], STEMS[1::2]))
    df = spark.createDataFrame(pairs, "word string, expected string").withColumn("got", stem("word"))
    assert df.where("got <> expected").collect() == []


@pytest.mark.parametrize("word, expected", [
    ("ays", "ai"), ("yes", "ye"), ("is", "is"), ("y", "y"), ("Running", "Run"), ("RUNNING", "RUNNING"),
    ("eed", "eed"), ("ing", "ing"), ("ñññed", "ñññed"),
])
def test_stemmer_corners(spark, word, expected):
    assert one(spark, word, stem("t")) == expected


@pytest.mark.parametrize("text, word", [
    ("from. x", "from"), ("from: x", "from"), ("x.1", "x"), ("déjà vu", "déjà"), ("dogs' x", "dogs"),
    ("it's", ""), ("a.b", ""), ("x_", ""), ("x1", ""), ("xД", ""), ("x́", ""), ("a:é", ""),
])
def test_plain_words_take_the_short_pattern(spark, text, word):
    assert one(spark, text, F.regexp_extract("t", f"^{T._PLAIN}", 0)) == word


@pytest.mark.parametrize("text, tokens", [
    ("The Quick, brown fox.", ["The", "Quick", "brown", "fox"]),
    ("it's O’Neil's rock'n'roll", ["it's", "O’Neil's", "rock'n'roll"]),
    ("U.S.A. 1,000.5 a.1 3;4", ["U.S.A", "1,000.5", "a", "1", "3;4"]),
    ("x_y __ _z er/ha", ["x_y", "_z", "er", "ha"]),
    ("漢字かな naïve", ["漢", "字", "か", "な", "naïve"]),
    ("  ", []),
])
def test_tokenize(spark, text, tokens):
    assert one(spark, text, T.tokenize("t")) == tokens


def test_very_long_tokens(spark):
    df = spark.range(1).select(
        F.repeat(F.lit("a1.5_"), 100000).alias("a"), F.repeat(F.lit("a.b:c'd"), 100000).alias("b"),
        F.repeat(F.lit("_"), 100000).alias("c"),
    )
    assert tuple(df.select(*[F.size(T.tokenize(c)) for c in "abc"]).first()) == (1, 1, 0)
    assert df.select(F.size(T.word_pieces("b"))).first()[0] > 1


def test_analyzers(spark):
    text = "The dog's Running of THE dogs, and the end"
    assert one(spark, text, T.analyze_english("t")) == [None, "dog", "run", None, None, "dog", None, None, "end"]
    # Upper case stop words stay, and so do capitals that match no suffix.
    assert one(spark, text, T.analyze_case_sensitive("t")) == ["The", "dog", "Run", None, "THE", "dog", None, None, "end"]
    # Without stemming the possessive stays too.
    assert one(spark, text, T.analyze_no_stem("t")) == [None, "dog's", "running", None, None, "dogs", None, None, "end"]
    assert one(spark, text, T.analyze_case_sensitive_no_stem("t")) == [
        "The", "dog's", "Running", None, "THE", "dogs", None, None, "end"
    ]


def test_stop_words_are_an_argument(spark):
    assert one(spark, "the dog", T.analyze_no_stem("t", ["dog"])) == ["the", None]
    assert one(spark, "the dog", T.analyze_no_stem("t", [])) == ["the", "dog"]


@pytest.mark.parametrize("token, bare", [("dog's", "dog"), ("DOG’S", "DOG"), ("dogs", "dogs"), ("s", "s"), ("it＇s", "it")])
def test_strip_possessive(spark, token, bare):
    assert one(spark, token, T.strip_possessive("t")) == bare


def test_contents_field(spark):
    df = spark.createDataFrame(
        [(False, False), (True, False), (False, True), (True, True), (None, None)], "c boolean, s boolean"
    )
    got = [r[0] for r in df.select(T.contents_field(F.col("c"), F.col("s"))).collect()]
    assert got == [T.NO_STEM, T.CASE_SENSITIVE_NO_STEM, T.ENGLISH, T.CASE_SENSITIVE, T.NO_STEM]


@pytest.mark.parametrize("text, term, hit", [
    ("A Test here", "test", True), ("attest", "test", False), ("a.b", "a.b", True), ("axb", "a.b", False),
    ("f(x) = (y)", "(y)", False), ("f(x)z", "(x)", True), ("q\\Ez", "q\\Ez", True),
])
def test_word_regex_match(spark, text, term, hit):
    df = spark.createDataFrame([(text, term)], "a string, b string")
    assert df.select(T.word_regex_match(F.col("a"), F.col("b"))).first()[0] is hit


def test_word_regex_match_raw(spark):
    df = spark.createDataFrame([("axb", "a.b")], "a string, b string")
    assert df.select(T.word_regex_match(F.col("a"), F.col("b"), regex_terms=True)).first()[0]


def test_strings(spark):
    df = spark.createDataFrame([(7, "a/b|c", "\t x \n")], "i int, t string, s string")
    row = df.select(S.query_id(F.col("i"), F.col("t")), S.strip(F.col("s"))).first()
    assert tuple(row) == ("7_a|b|c", "x")
    assert S.subset_table("rocks", "nlp") == "rocks_nlp"
    with pytest.raises(ValueError):
        S.subset_table("rocks; drop", "nlp")

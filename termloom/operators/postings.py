"""Where every word stands: phrases looked up instead of read for.

A posting is (field, bucket, token, docid, positions): the places of one word in one
analysed document. The bucket is a hash of the word and divides the files, which are
sorted by word, so that looking a few words up opens a few hundredths of the files and
a few pages of these. A phrase is looked for where its rarest word stands; the other
words' places are then compared in those documents only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.functions import text as T
from termloom.operators.phrase import SEPARATOR, Phrases
from termloom.sources.scratch import settle, write_parquet

BUCKETS = 256
SCHEMA = "field string, bucket int, token string, docid string, time timestamp, positions array<int>"

# Dictionaries of up to so many phrases are looked up; for more the documents are read once.
MOST_PHRASES = 20_000


def bucket_of(token: str) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(BUCKETS)).cast("int")


def build_postings(
    analyzed: DataFrame,
    ids: Sequence[str] = ("docid",),
    carried: Sequence[str] = ("time",),
    stop_words: Sequence[str] = T.STOP_WORDS,
) -> DataFrame:
    """(field, bucket, token, ids, carried, positions) of analysed documents, ready to be written.

    Stop words are in no phrase and have no postings. The rows of a bucket come
    together, those of a frequent word in several tasks.

    The places of a document's words are gathered within its row, so that postings are
    shuffled once, to their buckets. Only documents that are there more than once are
    grouped first; ``analyzed`` is read for their ids and should be stored.
    """
    keys = ["field", *ids]
    repeated = settle(analyzed.groupBy(*keys).count().where("count > 1").select(*keys))
    if repeated.isEmpty():
        rows = _gathered(analyzed, ids, carried)
    else:
        once = _gathered(analyzed.join(repeated, keys, "left_anti"), ids, carried)
        again = _gathered(analyzed.join(repeated, keys, "left_semi"), ids, carried)
        again = again.groupBy("field", "token", *ids, *carried).agg(
            F.sort_array(F.flatten(F.collect_list("positions"))).alias("positions")
        )
        rows = once.unionByName(again)
    if stop_words:
        rows = rows.where(F.col("field").isin(*T.STEMMED) | ~F.col("token").isin(*stop_words))
    rows = rows.select("field", bucket_of("token").alias("bucket"), "token", *ids, *carried, "positions")
    return rows.hint("rebalance", "field", "bucket").sortWithinPartitions("field", "bucket", "token", *ids)


def write_postings(analyzed: DataFrame, path: str, **how) -> None:
    """Write ``build_postings`` of stored forms, one field after the other.

    The postings of a field are shuffled alone, and its shuffle files go before the next.
    """
    for field in T.FIELDS:
        rows = build_postings(analyzed.where(F.col("field") == field), **how)
        write_parquet(rows.drop("field"), f"{path}/field={field}", ["bucket"])


def _gathered(analyzed: DataFrame, ids: Sequence[str], carried: Sequence[str]) -> DataFrame:
    """(ids, carried, field, token, positions): the words of every row with their places, by sorting its tokens."""
    placed = "filter(transform(toks, (t, i) -> named_struct('token', t, 'pos', i)), w -> w.token IS NOT NULL)"
    others = [*ids, *carried, "field"]
    rows = analyzed.select(*others, F.sort_array(F.expr(placed)).alias("_words"))
    begun = F.expr(
        "filter(transform(_words, (w, i) -> if(i = 0 OR w.token <> get(_words, i - 1).token, i, NULL)), i -> i IS NOT NULL)"
    )
    rows = rows.select(*others, "_words", begun.alias("_begun"))
    each = F.expr(
        "transform(_begun, (b, k) -> named_struct('token', get(_words, b).token, "
        "'positions', transform(slice(_words, b + 1, ifnull(get(_begun, k + 1), size(_words)) - b), w -> w.pos)))"
    )
    # The outer form keeps Catalyst from testing the array first, which would make it twice.
    rows = rows.select(*others, F.inline_outer(each))
    return rows.where("token IS NOT NULL")


def _words(phrases: Phrases) -> DataFrame:
    """(field, gram, n, offset, token, bucket): the words of every phrase."""
    spelled = phrases.rows.select("field", "gram", "offsets").distinct()
    n = F.size("offsets")
    tokens = F.slice(F.split("gram", SEPARATOR), F.lit(2), n)
    each = spelled.select("field", "gram", "offsets", n.alias("n"), F.posexplode(tokens).alias("nth", "token"))
    return each.select(
        "field", "gram", "n", F.get("offsets", F.col("nth")).alias("offset"), "token", bucket_of("token").alias("bucket")
    )


def _shifted(positions: str, offset: str) -> Column:
    """Where a phrase would begin that has this word at ``offset``."""
    return F.expr(f"transform({positions}, p -> p - {offset})")


def count_by_postings(postings: DataFrame, phrases: Phrases, ids: Sequence[str] = ("docid",)) -> DataFrame:
    """(ids, field, gram, hits): how often each phrase starts in each document."""
    hint = F.broadcast if phrases.small else (lambda rows: rows)
    words = _words(phrases)
    buckets = [row["bucket"] for row in words.select("bucket").distinct().collect()]  # 256 at most
    held = postings.where(F.col("field").isin(phrases.fields) & F.col("bucket").isin(buckets))
    held = held.select("field", "bucket", "token", *ids, "positions").join(
        hint(words.select("field", "bucket", "token").distinct()), ["field", "bucket", "token"], "left_semi"
    ).drop("bucket")

    several = words.where("n > 1")
    often = held.join(hint(several.select("field", "token").distinct()), ["field", "token"], "left_semi")
    often = often.groupBy("field", "token").agg(F.count("*").alias("df"))
    known = F.coalesce("df", F.lit(0))
    leads = (
        several.join(often, ["field", "token"], "left")
        .groupBy("field", "gram", "n")
        .agg(
            F.min(F.struct(known.alias("df"), "offset", "token")).alias("lead"),
            F.collect_list(F.struct("offset", "token")).alias("words"),
        )
        .where("lead.df > 0")
    )
    firsts = leads.select(
        "field", "gram", "n", F.col("lead.token").alias("token"), F.col("lead.offset").alias("offset"),
        F.filter("words", lambda w: w["offset"] != F.col("lead.offset")).alias("others"),
    )
    met = held.join(hint(firsts), ["field", "token"]).select(
        *ids, "field", "gram", "n", _shifted("positions", "offset").alias("starts"), F.explode("others").alias("other")
    )
    both = met.select(
        *ids, "field", "gram", "n", "starts", F.col("other.token").alias("token"), F.col("other.offset").alias("offset")
    ).join(held, [*ids, "field", "token"])
    shared = F.array_intersect("starts", _shifted("positions", "offset"))
    found = both.select(*ids, "field", "gram", "n", shared.alias("starts")).where(F.size("starts") > 0)
    whole = found.groupBy(*ids, "field", "gram", "n").agg(F.collect_list("starts").alias("sets"))
    all_met = F.aggregate("sets", F.get("sets", F.lit(0)), lambda one, other: F.array_intersect(one, other))
    counted = whole.where(F.size("sets") == F.col("n") - 1).select(*ids, "field", "gram", F.size(all_met).alias("hits"))

    single = held.join(hint(words.where("n = 1").select("field", "gram", "token")), ["field", "token"])
    rows = single.select(*ids, "field", "gram", F.size("positions").alias("hits"))
    return rows.unionByName(counted.where("hits > 0"))

"""Language identification by compression.

Each language has a zstandard dictionary of raw content: pieces of its training texts.
A text goes through every language's compressor in pieces, so that it does not learn
from itself; the language with the smallest total wins.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.shared import held_out, lowest

PIECE, LEVEL = 2048, 5
LETTER = re.compile(r"[^\W\d_]")
UNKNOWN = "und"


def fit(docs: DataFrame, folds: int = 4, fold: int = 2, docs_per_lang: int = 400, dictionary_bytes: int = 96 << 10, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, bytes]:
    """A dictionary for each language that occurs outside the held-out fold, the most frequent language first.

    The sample has at most docs_per_lang documents of each language, chosen by a hash
    of the id before the shuffle. Each gives one piece, from a place that the hash
    names as well, of an even share of the dictionary. Rows with a null or empty text or
    a null language teach nothing, those with a null id count as one id, repeated rows
    give their piece again; an empty table gives no language.
    """
    rows = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    known = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.length("text") > 0) & ~held_out(F.col("key"), folds, fold))
    mark = F.xxhash64("key", F.lit(1))
    chosen = lowest(known.select("key", "lang", mark.alias("mark")), "lang", docs_per_lang)
    share = F.lit(max(64, dictionary_bytes // docs_per_lang))
    # a fixed number of rows for each language
    texts = known.join(F.broadcast(chosen.distinct()), ["key", "lang"])
    at = F.pmod("mark", F.greatest(F.lit(1), F.length("text") - share + 1)).cast("int") + 1
    pieces = texts.select("lang", "mark", F.substring("text", at, share).alias("piece")).orderBy("lang", "mark", "piece").collect()
    found: dict[str, list[str]] = {}
    for r in pieces:
        found.setdefault(r["lang"], []).append(r["piece"])
    out = {}
    counts = {r[0]: r[1] for r in known.groupBy("lang").count().collect()}
    for lang, parts in sorted(found.items(), key=lambda x: (-counts[x[0]], x[0])):
        data = b" ".join(map(normal, parts))
        out[lang] = data[-dictionary_bytes:] if len(data) >= 8 else data.ljust(8)
    return out


def normal(text: str) -> bytes:
    """The text itself, in lower case."""
    return text.lower().encode("utf-8", "surrogatepass")


def compressors(dictionaries: dict[str, bytes]) -> list[zstandard.ZstdCompressor]:
    out = []
    for data in dictionaries.values():
        content = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        content.precompute_compress(level=LEVEL)
        out.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=content, write_content_size=False, write_dict_id=False))
    return out


def sizes(text: str, by: list[zstandard.ZstdCompressor]) -> np.ndarray:
    """Compressed bytes of the whole text, by language, in even pieces."""
    data = normal(text)
    pieces = [data[i : i + PIECE] for i in range(0, len(data), PIECE)]
    return np.array([sum(len(c.compress(p)) for p in pieces) for c in by], np.int64)


def verdict(total: np.ndarray, least_margin: float) -> tuple[int, float]:
    """(place of the smallest size or -1, score): the first of equal sizes, rejected if the next is within the margin."""
    best = int(total.argmin())
    gap = (total - total[best]) / max(1, int(total[best]))
    score = float(1 / np.exp2(-(np.minimum(total - total[best], 400)) / 4).sum())
    rest = np.delete(gap, best)
    return (-1 if len(rest) and rest.min() < least_margin else best), score


def predict(docs: DataFrame, dictionaries: dict[str, bytes], least_margin: float = 0.0, folds: int = 4, fold: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, held_out, lang_pred, score.

    Only the text is read, all of it. lang_pred is `und` with score 0 where the text is
    null or has no letter, where no language was learned, and where the best language
    saves less than `least_margin` of its size against the next one (0: never). Equal
    sizes, as very short texts have, go to the language first in `dictionaries`. The score is 1 / (number of languages)
    where all are equal, and nears 1 as the others need more bytes. Repeated rows are
    predicted each; an empty table gives no rows.
    """
    names = list(dictionaries)
    sent = docs.sparkSession.sparkContext.broadcast(dictionaries)  # a fixed size for each language

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = compressors(sent.value)
        for batch in batches:
            langs, scores = [], []
            for text in batch.column(2).to_pylist():
                lang, score = UNKNOWN, 0.0
                if by and text and LETTER.search(text):
                    best, found = verdict(sizes(text, by), least_margin)
                    if best >= 0:
                        lang, score = names[best], found
                langs.append(lang), scores.append(score)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col), folds, fold).alias("held_out"), F.col(text_col).alias("text"))
    return rows.mapInArrow(apply, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, held_out boolean, lang_pred string, score double")

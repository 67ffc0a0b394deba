"""Quality scores by supervised subword embeddings.

A document is the mean of learned vectors of its words and of the character n-grams
inside them, all hashed into buckets; a softmax over two labels reads that mean. The
vectors are trained by stochastic gradient descent on a bounded sample of labelled
documents. As the output is linear in the mean, a bucket's vector acts on a score
through one number alone, and these numbers are what the tasks get.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm import arrays as A
from termloom.llm.shared import held_out, label_shares, labelled_sample

BITS, GRAMS = 18, (3, 4, 5)
#: Tokens of the mean vector that every document has besides its own; a few words decide less than many.
FILL = 12.0


def tokens(points: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(buckets, bounds by text) of the words, of word pairs, then of the character n-grams of each size.

    A pair is hashed by the difference of its words, so all immediate repeats are one.
    A gram may begin or end with the space beside a word, and holds none inside.
    """
    shift = A.U(64 - BITS)
    word, bounds = A.words(points, starts, A.not_ascii_space())
    yield (word >> shift).astype(np.int32), bounds
    if len(word) > 1:
        pair = A.mixed(word[1:] - word[:-1] + A.U(1))
        inside = np.ones(len(pair), bool)
        inside[bounds[(bounds > 0) & (bounds < len(word))] - 1] = False
        kept = np.flatnonzero(inside)
        yield (pair[kept] >> shift).astype(np.int32), np.searchsorted(kept, bounds)
    space = ~A.not_ascii_space()[points]
    codes = A.point_codes()[np.where(space, np.uint32(32), points)]
    inner = np.concatenate([[0], np.cumsum(space)])
    gram, step = codes.copy(), A.powers(max(GRAMS), A.BY_WORD)
    begins = np.ones(len(codes), bool)
    begins[starts[1:] - 1] = False  # what begins at the end of a text is made of the next one
    for n in range(2, max(GRAMS) + 1):
        if len(codes) < n:
            break
        gram = gram[: len(codes) - n + 1] + codes[n - 1 :] * step[n - 1]
        if n in GRAMS:
            first = np.arange(len(gram))
            full = np.flatnonzero((inner[first + n - 1] == inner[first + 1]) & begins[: len(gram)])
            yield (A.mixed(gram[full]) >> shift).astype(np.int32), np.searchsorted(full, starts)


@dataclass
class Model:
    weights: np.ndarray  # of each bucket, for the log odds of label 1
    bias: float

    def scores(self, texts: list[str]) -> np.ndarray:
        out = np.zeros(len(texts))
        for at, some in A.chunks(texts):
            points, starts = A.laid_out(some)
            total, count = np.zeros(len(some)), np.zeros(len(some))
            for buckets, bounds in tokens(points, starts):
                total += A.sums(self.weights[buckets], bounds)
                count += np.diff(bounds)
            out[at : at + len(some)] = total / (count + FILL)
        return 1 / (1 + np.exp(-np.clip(out + self.bias, -40, 40)))


def _sampled(docs: DataFrame, sample: DataFrame, id_col: str, text_col: str) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(label, distinct buckets, their shares) of the sampled documents, counted in the tasks."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, ids, shares = batch.column(0), [], []
            for text in batch.column(1).to_pylist():
                points, starts = A.laid_out([text or ""])
                found = [b for b, _ in tokens(points, starts)]
                own, times = np.unique(np.concatenate(found), return_counts=True)
                ids.append(own.astype("<i4").tobytes())
                shares.append((times / (times.sum() + FILL)).astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays([labels, pa.array(ids, pa.binary()), pa.array(shares, pa.binary())], ["y", "ids", "shares"])

    texts = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text")).join(F.broadcast(sample), "key")
    found = texts.select("y", "text").mapInArrow(count, "y int, ids binary, shares binary").collect()
    rows = [(r["y"], np.frombuffer(r["ids"], "<i4"), np.frombuffer(r["shares"], "<f4")) for r in found]
    return sorted(rows, key=lambda r: (r[0], len(r[1]), r[1].tobytes()))


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], prior: float, dim: int = 16, epochs: int = 6, rate: float = 0.5, seed: int = 7) -> Model:
    """Stochastic gradient descent, one document at a time; labels weigh alike, and the prior comes in at the end."""
    logit = float(np.log(prior / (1 - prior))) if 0 < prior < 1 else (8.0 if prior >= 1 else -8.0)
    n_one = sum(y for y, _, _ in rows)
    if not rows or n_one in (0, len(rows)):
        return Model(np.zeros(1 << BITS, np.float32), logit)
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (1 << BITS, dim)).astype(np.float32)
    out, bias = np.zeros((dim, 2), np.float32), np.zeros(2, np.float32)
    weigh = (0.5 * len(rows) / (len(rows) - n_one), 0.5 * len(rows) / n_one)
    steps, done = epochs * len(rows), 0
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            y, ids, share = rows[i]
            own = vectors[ids]
            mean = share @ own
            z = mean @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            p *= rate * (1 - done / steps) * weigh[y]
            vectors[ids] = own - np.outer(share, out @ p) * np.float32(len(ids) ** 0.5)
            out -= np.outer(mean, p)
            bias -= p
            done += 1
    return Model((vectors @ (out[:, 1] - out[:, 0])).astype(np.float32), float(bias[1] - bias[0]) + logit)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 5, fold: int = 0, rows_per_label: int = 1500, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Trained on at most rows_per_label documents of each label outside the held-out fold; the prior is counted over all of them."""
    shares = label_shares(labels, id_col, label, folds, fold)
    total = shares.get(0, 0) + shares.get(1, 0)
    prior = shares.get(1, 0) / total if total else 0.5
    sample = labelled_sample(labels, id_col, label, folds, fold, rows_per_label)
    return train([r for r in _sampled(docs, sample, id_col, text_col) if r[0] in (0, 1)], prior)


def score(docs: DataFrame, model: Model, folds: int = 5, fold: int = 0, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, held_out, score (0 to 1, higher: label 1 likelier), predicted.

    The score reads the whole text and nothing else. Null and empty texts, and texts of
    white space, get the score of an empty mean. Repeated rows are scored each; without
    usable labels every score is the prior. An empty table gives no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # one number per bucket

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = sent.value.scores([t or "" for t in batch.column(2).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col), folds, fold).alias("held_out"), F.col(text_col).alias("text"))
    return rows.mapInArrow(apply, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double, predicted int")

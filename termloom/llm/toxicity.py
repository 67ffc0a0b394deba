"""Toxicity by weak supervision.

Many weak voters (lexicons and patterns) vote toxic, clean or nothing on a sample. A
generative model estimates, without labels, how often each voter is right and which
voters depend on each other, and gives every sampled document a posterior. A linear
classifier over the words of a text learns these posteriors and scores the corpus.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm import arrays as A
from termloom.llm.shared import few, held_out, label_shares, labelled_sample

#: Insults known beforehand, by how they wound.
GENERAL = {
    "mind": "idiot moron stupid dumb imbecile fool retard dimwit cretin dunce halfwit",
    "worth": "worthless pathetic loser useless failure nobody trash garbage scum filth vermin",
    "person": "clown jerk bastard creep freak pig coward liar",
    "disgust": "disgusting vile repulsive revolting nasty",
    "threat": "kill destroy murder strangle",
}
#: Pattern voters: (name, pattern, vote); 1 toxic, -1 clean.
PATTERNS = [
    ("addressed", r"\b(?:you|your|you're|u)\b[^.!?\n]{0,40}\b(?:idiot|moron|stupid|loser|trash|scum|clown|pathetic|worthless)", 1),
    ("shouted", r"\b(?:IDIOT|MORON|STUPID|LOSER|SCUM|TRASH|CLOWN|PATHETIC|WORTHLESS|DISGUSTING)\b", 1),
    ("wished", r"\b(?:go|just|should)\s+(?:die|away|hang)\b", 1),
    ("censored", r"\b[a-zA-Z]+[*#@$%]{2,}[a-zA-Z]+\b", 1),
]
LEARNED_VOTERS = 6
WORD = re.compile(r"[^\W\d_]+")
#: A feature is a word, or the first letters of a longer one, at a share of a text's words.
PREFIXES, SHARES = (5, 6, 7, 8), (0.0, 0.005, 0.02)


def units(points: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, texts, words by text) of the words of all texts, then of their prefixes of each length."""
    mask = A.letters()[points]
    if not mask.any():
        return
    edge = np.diff(mask.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    begin, length = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - np.flatnonzero(edge == 1)
    text = np.searchsorted(starts, begin, "right") - 1
    total = np.bincount(text, minlength=len(starts) - 1)
    place = np.arange(mask.sum()) - np.repeat(np.cumsum(length) - length, length)
    terms = A.point_codes()[points[mask]] * A.powers(int(length.max()), A.BY_CHAR)[place]
    for k in (0, *PREFIXES):
        if k:
            longer = length > k
            if not longer.any():
                return
            part = terms[np.repeat(longer, length) & (place < k)].reshape(-1, k).sum(1, dtype=A.U)
            yield A.mixed(part + A.U(k)) & ~A.U(3), text[longer], total
        else:
            yield A.mixed(np.add.reduceat(terms, np.cumsum(length) - length)) & ~A.U(3), text, total


def features(text: str) -> np.ndarray:
    """Sorted distinct features of one text: a unit's id plus the place of each share that it reaches."""
    out = [np.zeros(0, A.U)]
    for ids, _, total in units(*A.laid_out([text.lower()])):
        own, times = np.unique(ids, return_counts=True)
        out += [own[times >= share * total[0]] + A.U(level) for level, share in enumerate(SHARES)]
    return np.unique(np.concatenate(out))


def general_votes(text: str) -> list[int]:
    """Of the lexicons known beforehand, then of the patterns."""
    own = set(WORD.findall(text.lower()))
    return [*(int(not own.isdisjoint(v.split())) for v in GENERAL.values()), *(v if re.search(p, text) else 0 for _, p, v in PATTERNS)]


@dataclass
class Sample:
    """Labelled texts: label, a mark that copies mostly share, votes of the general voters, features."""

    y: np.ndarray
    marks: np.ndarray
    votes: np.ndarray
    rows: list[np.ndarray]  # of places in vocabulary
    vocabulary: np.ndarray

    def learned(self, most: int = 192, least_texts: int = 4, least_share: float = 0.03, least_odds: float = 3.0) -> list[np.ndarray]:
        """Lexicons of features that stand in far more toxic texts than others, dealt out by strength.

        Copies, near ones as well, mostly share their smallest word pair and count as one text.
        """
        _, first = np.unique(np.stack([self.y, self.marks], 1), axis=0, return_index=True)
        toxic, clean = (np.bincount(np.concatenate([self.rows[i] for i in first if self.y[i] == y] or [np.zeros(0, int)]), minlength=len(self.vocabulary)) for y in (1, 0))
        n_toxic, n_clean = (max(1, int((self.y[first] == y).sum())) for y in (1, 0))
        odds = np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((clean + 0.5) / (n_clean + 1))
        good = np.flatnonzero((toxic >= max(least_texts, least_share * n_toxic)) & (odds >= least_odds))
        good = good[np.argsort(-odds[good] * np.log1p(toxic[good]), kind="stable")][:most]
        return [part for k in range(LEARNED_VOTERS) if len(part := good[k::LEARNED_VOTERS])]

    def all_votes(self, lexicons: list[np.ndarray]) -> np.ndarray:
        """General voters, learned lexicons, and two that vote clean without a learned feature: in any text, and in a longer one."""
        learned = np.array([[int(np.isin(part, row, assume_unique=True).any()) for part in lexicons] for row in self.rows], np.int64).reshape(len(self.y), -1)
        none = learned.sum(1) == 0
        long = np.array([len(r) for r in self.rows]) >= 60
        return np.column_stack([self.votes, learned, np.where(none, -1, 0), np.where(none & long, -1, 0)])


@dataclass
class LabelModel:
    """P(vote | label) of each voter, and how much each is discounted for voters that err along with it."""

    logs: np.ndarray  # voter, label, vote + 1
    discount: np.ndarray
    log_prior: float

    @classmethod
    def fit(cls, votes: np.ndarray, prior: float, rounds: int = 40) -> LabelModel:
        """Expectation maximisation from the majority vote; votes: rows of -1, 0, 1.

        Correlations are those of the votes' residuals once the posterior is known; a
        voter's evidence is divided by one plus its positive ones.
        """
        n = votes.shape[1]
        prior = min(max(prior, 1e-3), 1 - 1e-3)
        shown = np.stack([votes == v for v in (-1, 0, 1)], 2).astype(float)  # row, voter, vote
        log_prior = float(np.log(prior / (1 - prior)))
        posterior = 1 / (1 + np.exp(-(2.0 * (votes > 0).sum(1) - (votes < 0).sum(1))))
        discount, model = np.ones(n), None
        for k in range(rounds):
            tables = np.stack([np.einsum("r,rvx->vx", w, shown) for w in (1 - posterior, posterior)], 1) + 0.5
            logs = np.log(tables / tables.sum(2, keepdims=True))
            model = cls(logs, discount, log_prior)
            posterior = model.posteriors(votes)
            if k % 10 == 9:
                mean = np.exp(logs[:, 1, 2] - 0) - np.exp(logs[:, 1, 0]), np.exp(logs[:, 0, 2]) - np.exp(logs[:, 0, 0])
                left = votes - posterior[:, None] * mean[0] - (1 - posterior[:, None]) * mean[1]
                scale = np.sqrt((left**2).mean(0)) + 1e-9
                shared = (left.T @ left) / len(left) / np.outer(scale, scale)
                np.fill_diagonal(shared, 0)
                discount = 1 / (1 + np.clip(shared, 0, 1).sum(1))
        return model

    def posteriors(self, votes: np.ndarray) -> np.ndarray:
        ratio = self.logs[:, 1] - self.logs[:, 0]  # voter, vote + 1
        odds = (ratio[np.arange(votes.shape[1]), votes + 1] * self.discount).sum(1) + self.log_prior
        return 1 / (1 + np.exp(-np.clip(odds, -40, 40)))


@dataclass
class Model:
    """ids: units with weight, sorted; weights: one for each share that a unit reaches in a text; and the bias."""

    ids: np.ndarray
    weights: np.ndarray
    bias: float

    @classmethod
    def of(cls, features: np.ndarray, weights: np.ndarray, bias: float) -> Model:
        ids, place = np.unique(features & ~A.U(3), return_inverse=True)
        table = np.zeros((len(ids), len(SHARES)))
        table[place, (features & A.U(3)).astype(int)] = weights
        return cls(ids, table, bias)

    def scores(self, texts: list[str]) -> np.ndarray:
        odds = np.full(len(texts), self.bias)
        n = len(self.ids)
        for at, some in A.chunks([t.lower() for t in texts]) if n else ():
            for ids, text, total in units(*A.laid_out(some)):
                place = np.minimum(np.searchsorted(self.ids, ids), n - 1)
                hit = np.flatnonzero(self.ids[place] == ids)
                pair, times = np.unique(text[hit] * np.int64(n) + place[hit], return_counts=True)
                of, unit = pair // n, pair % n
                reached = times[:, None] >= np.array(SHARES) * total[of][:, None]
                odds[at : at + len(some)] += np.bincount(of, (self.weights[unit] * reached).sum(1), len(some))
        return 1 / (1 + np.exp(-np.clip(odds, -40, 40)))


def linear(rows: list[np.ndarray], posterior: np.ndarray, weight: np.ndarray, features: int, most: int = 512, penalty: float = 3e-4, rounds: int = 500) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels with an absolute penalty; rows: distinct features of each text.

    Only the `most` features with the strongest slope where nothing is learned yet,
    against its spread, take part; the penalty leaves many of them without weight.
    """
    of = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    cols = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    share = weight / weight.sum()
    rate = float(np.clip((share * posterior).sum(), 1e-4, 1 - 1e-4))
    out, b = np.zeros(features), float(np.log(rate / (1 - rate)))
    slope = np.bincount(cols, ((posterior - rate) * share)[of], features)
    spread = np.sqrt(np.bincount(cols, (share**2)[of], features)) + 1e-9
    used = np.sort(np.argsort(-np.abs(slope / spread), kind="stable")[:most])
    place = np.full(features, -1)
    place[used] = np.arange(len(used))
    inside = place[cols] >= 0
    of, cols = of[inside], place[cols[inside]]

    def forward(w: np.ndarray) -> np.ndarray:
        return np.bincount(of, w[cols], len(rows))

    v = np.ones(len(used) + 1)  # the largest curvature, for the step
    for _ in range(30):
        v /= np.linalg.norm(v)
        z = (forward(v[:-1]) + v[-1]) * share / 4
        v = np.append(np.bincount(cols, z[of], len(used)), z.sum())
    step = 1 / max(1e-9, float(np.linalg.norm(v)))
    w = ahead = np.zeros(len(used))
    b_ahead, t = b, 1.0
    for _ in range(rounds):
        error = (1 / (1 + np.exp(-np.clip(forward(ahead) + b_ahead, -40, 40))) - posterior) * share
        new = ahead - step * np.bincount(cols, error[of], len(used))
        new = np.sign(new) * np.maximum(np.abs(new) - step * penalty, 0)
        b_new = b_ahead - step * float(error.sum())
        later = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, b_ahead = new + (t - 1) / later * (new - w), b_new + (t - 1) / later * (b_new - b)
        w, b, t = new, b_new, later
    out[used] = w
    return out, b


def collected(texts: DataFrame, least_texts: int = 4) -> Sample:
    """texts (y, text), of bounded number; features of fewer than least_texts of them are left out."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few(batches):
            rows = batch.column(1).to_pylist()
            pairs = [A.shingles(*A.words(*A.laid_out([t.lower()]), A.letters()), 2)[0] >> A.U(1) for t in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([int(p.min(initial=np.iinfo(np.int64).max)) for p in pairs], pa.int64()),
                 pa.array([general_votes(t) for t in rows], pa.list_(pa.int32())), pa.array([features(t).tobytes() for t in rows], pa.binary())], ["y", "mark", "votes", "features"])

    found = texts.select("y", "text").mapInArrow(read, "y int, mark long, votes array<int>, features binary").collect()
    found = sorted((r for r in found if r["y"] in (0, 1)), key=lambda r: (r["y"], r["mark"], bytes(r["features"])))
    own = [np.frombuffer(r["features"], "<u8") for r in found]
    vocabulary, times = np.unique(np.concatenate(own), return_counts=True) if own else (np.zeros(0, A.U), np.zeros(0))
    vocabulary = vocabulary[times >= least_texts]
    rows = [at[vocabulary[at] == w] for w in own if len(vocabulary) for at in [np.minimum(np.searchsorted(vocabulary, w), len(vocabulary) - 1)]]
    return Sample(
        np.array([r["y"] for r in found], int), np.array([r["mark"] for r in found], np.int64), np.array([r["votes"] for r in found], np.int64).reshape(len(found), len(GENERAL) + len(PATTERNS)),
        rows if len(vocabulary) else [np.zeros(0, int)] * len(own), vocabulary)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 5, fold: int = 0, rows_per_label: int = 2000, id_col: str = "doc_id", text_col: str = "text") -> tuple[Model, LabelModel | None]:
    """Fitted on at most rows_per_label documents of each label outside the held-out fold.

    Labels only build the learned lexicons and, counted over all of them, the prior; the
    classifier sees posteriors, and all of its weights come from them. Without labelled
    texts there is nothing to learn from, and every text has the same low score.
    """
    shares = label_shares(labels, id_col, label, folds, fold)
    total = shares.get(0, 0) + shares.get(1, 0)
    prior = shares.get(1, 0) / total if total else 0.1
    sample = labelled_sample(labels, id_col, label, folds, fold, rows_per_label)
    texts = docs.select(F.col(id_col).alias("key"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(F.broadcast(sample), "key")
    found = collected(texts)
    if not len(found.y):
        return Model(np.zeros(0, A.U), np.zeros((0, len(SHARES))), -3.0), None
    votes = found.all_votes(found.learned())
    n_toxic = int((found.y == 1).sum())
    label_model = LabelModel.fit(votes, n_toxic / len(votes))
    posterior = label_model.posteriors(votes)
    # the sample has both labels alike; weights bring back how often each occurs
    weight = np.where(found.y == 1, prior / max(1, n_toxic), (1 - prior) / max(1, len(votes) - n_toxic)) + 1e-9
    weights, bias = linear(found.rows, posterior, weight, len(found.vocabulary))
    used = np.flatnonzero(weights)
    return Model.of(found.vocabulary[used], weights[used], bias), label_model


def score(docs: DataFrame, model: Model, folds: int = 5, fold: int = 0, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, held_out, score (0 to 1, higher: label 1 likelier), predicted.

    The score reads the whole text and nothing else; null and empty texts, and texts
    without a letter, get the bias. Repeated rows are scored each; an empty table gives
    no rows.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # words of a bounded sample

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few(batches):
            scores = sent.value.scores([t or "" for t in batch.column(2).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col), folds, fold).alias("held_out"), F.col(text_col).alias("text"))
    return rows.mapInArrow(apply, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double, predicted int")


def without_toxic(docs: DataFrame, model: Model, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns, whose text scores below the threshold."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few(batches):
            scores = sent.value.scores([t or "" for t in batch.column(at).to_pylist()])
            yield batch.filter(pa.array(scores < threshold))

    return docs.mapInArrow(keep, docs.schema)

"""Toxicity: averaged subword-bag embeddings under a linear softmax, trained jointly in numpy.

A word is the bag of itself and its character n-grams, hashed to buckets, so a misspelling that training never saw still
shares most of its vectors with the word it imitates. A text's vector is the mean over its words. Embeddings and
softmax weights are trained together by gradient descent with momentum on a bounded sample of labelled documents.

With two classes the softmax sees only the projection of a vector on the difference of the two weight rows, so when
scoring a word is one number; nothing else about it is kept.

Defined results: a null text counts as empty; a text without words gets the model's score for the zero vector. With
nothing to learn from, or one class only, every score is the share of toxic documents among those there are, else 0.
Repeated rows are scored alike. Texts of any length are read whole. A score that equals the threshold counts as toxic. Of
several labels of one doc_id the larger counts, of several texts the one that sorts first is learnt from; a null doc_id is
scored but not learnt from. Columns besides doc_id, text and the label are ignored, whatever their names. An empty table
gives an empty result.

A bound besides the sample's: n-grams that fewer than MIN_TEXTS labelled texts hold, or fewer than 1 % of the smaller class,
are not fitted; their vectors stay zero.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import WordTable, fold, labelled_sample, score_texts, segment_sums, slices

BUCKETS = 1 << 17
DIMENSIONS = 16
GRAMS = (3, 4, 5)
#: Labelled documents of each class that the model is fitted on, at most about.
SAMPLE = 1600
THRESHOLD = 0.7
#: Weight of the toxic class in the loss.
TOXIC_SHARE = 0.35
#: Buckets that fewer texts of the sample have stay at zero.
MIN_TEXTS = 3
#: So do those that less than this share of the smaller class's number of texts have.
MIN_SHARE = 0.01
#: How far a bucket's gain evens out its spread over texts: 0 not at all, 1 wholly.
GAIN = 0.3
ROUNDS = 300
#: Words without their marks whose numbers a worker keeps.
CORES = 600_000
EDGES = re.compile(r"^[\W_]+|[\W_]+$")


def core_of(word: str) -> str:
    """A word without the marks at its edges, in lower case."""
    word = word.lower()
    return word if word.isalnum() else EDGES.sub("", word)


def buckets(core: str) -> list[int]:
    """Buckets of a word's core: itself and all its n-grams (of its UTF-8 bytes) between edge marks."""
    crc, marked = zlib.crc32, f"<{core}>".encode("utf-8", "replace")
    found, n = [crc(marked) % BUCKETS], len(marked)
    for size in GRAMS:
        found += [crc(marked[i : i + size], 7) % BUCKETS for i in range(n - size + 1)]
    return found


class Bags:
    """Sparse rows of bucket weights: each word counts 1/words, each of its buckets alike."""

    def __init__(self, texts: list[str]):
        own: dict[str, np.ndarray] = {}
        columns, values, counts = [], [], []
        for text in texts:
            words = text.split()
            for w in words:
                if w not in own:
                    own[w] = np.array(buckets(core_of(w)), np.int32)
            some = [own[w] for w in words]
            if some:
                sizes = np.array([*map(len, some)])
                col, back = np.unique(np.concatenate(some), return_inverse=True)
                val = np.bincount(back, np.repeat(1.0 / (len(words) * sizes), sizes))
                columns.append(col.astype(np.int32))
                values.append(val.astype(np.float32))
            counts.append(len(columns[-1]) if some else 0)
        self.columns = np.concatenate(columns) if columns else np.zeros(0, np.int32)
        self.values = np.concatenate(values) if values else np.zeros(0, np.float32)
        self.counts = np.array(counts)


@dataclass
class Model:
    """Projection of each bucket's embedding, and the bias; ``constant`` where nothing could be learnt."""

    projected: np.ndarray
    bias: float
    constant: float | None = None


def fit(sample: list[tuple[str, int]], rounds: int = ROUNDS, rate: float = 1.0, decay: float = 1e-3, seed: int = 11) -> Model:
    """Joint gradient descent with momentum on the embeddings and the two softmax rows.

    The step is scaled by the size of the whole gradient, not coordinate by coordinate: a bucket that many toxic texts
    share must move further than one that a single text has.
    """
    y = np.array([v for _, v in sample], float)
    if len(set(y)) < 2:
        return Model(np.zeros(BUCKETS, np.float32), 0.0, float(y.mean()) if len(y) else 0.0)
    bags = Bags([t for t, _ in sample])
    rows = np.repeat(np.arange(len(y), dtype=np.int32), bags.counts)
    fewest = max(MIN_TEXTS, MIN_SHARE * min((y == 1).sum(), (y == 0).sum()))
    known = np.flatnonzero(np.bincount(bags.columns, minlength=BUCKETS) >= fewest)
    place = np.full(BUCKETS, -1, np.int32)
    place[known] = np.arange(len(known))
    at = place[bags.columns]
    rows, values, at = rows[at >= 0].astype(np.int32), bags.values[at >= 0], at[at >= 0].astype(np.int32)
    if not len(at):
        return Model(np.zeros(BUCKETS, np.float32), 0.0, float(y.mean()))
    # a bucket's gain evens out how much it varies between texts
    mean = np.bincount(at, values, len(known)) / len(y)
    spread = np.sqrt(np.maximum(np.bincount(at, values * values, len(known)) / len(y) - mean * mean, 1e-18))
    gain = spread**-GAIN
    gain /= np.sqrt(np.mean((gain * spread) ** 2) * len(known))
    values *= gain[at].astype(np.float32)
    turn = np.argsort(at, kind="stable").astype(np.int32)
    by_row, by_bucket = _Sums(rows, len(y)), _Sums(at[turn], len(known))
    rows_turned, values_turned = rows[turn], values[turn]
    centre = np.bincount(at, values, len(known)) / len(y)
    rng = np.random.default_rng(seed)
    e, u, b = rng.normal(0, 0.01, (len(known), DIMENSIONS)), rng.normal(0, 1.0, (2, DIMENSIONS)), np.zeros(2)
    weight = np.where(y == 1, TOXIC_SHARE / (y == 1).sum(), (1 - TOXIC_SHARE) / (y == 0).sum())
    speed_e, speed_u, speed_b = np.zeros_like(e), np.zeros_like(u), np.zeros_like(b)
    for _ in range(rounds):
        apart = u[1] - u[0]
        one = e @ apart
        logit = by_row(values * one.astype(np.float32)[at]) - centre @ one + b[1] - b[0]
        delta = weight * (1 / (1 + np.exp(-np.clip(logit, -50, 50))) - y)  # of the toxic class; the other has its negative
        pull = by_bucket(values_turned * delta.astype(np.float32)[rows_turned]) - centre * delta.sum()
        mean_e = pull @ e  # the gradient of the toxic row
        speed_e = 0.9 * speed_e - rate * (np.outer(pull, apart) + decay * e)
        speed_u = 0.9 * speed_u - rate * (np.stack([-mean_e, mean_e]) + decay * u)
        speed_b = 0.9 * speed_b - rate * np.array([-delta.sum(), delta.sum()])
        e, u, b = e + speed_e, u + speed_u, b + speed_b
    one = e @ (u[1] - u[0])
    projected = np.zeros(BUCKETS, np.float32)
    projected[known] = one * gain
    return Model(projected, float(b[1] - b[0] - centre @ one))


class _Sums:
    """Sums of values by sorted keys."""

    def __init__(self, keys: np.ndarray, size: int):
        self.size = size
        self.starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        self.keys = keys[self.starts]

    def __call__(self, values: np.ndarray) -> np.ndarray:
        out = np.zeros(self.size)
        out[self.keys] = np.add.reduceat(values, self.starts, dtype=np.float64)
        return out


def _scorer(model: Model, threshold: float):
    weights = model.projected.tolist()
    cores: dict[str, float] = {}

    def rows(words: list[str]) -> np.ndarray:
        if len(cores) > CORES:
            cores.clear()
        out = []
        for w in words:
            core = core_of(w)
            if (value := cores.get(core)) is None:
                found = buckets(core)
                value = cores[core] = sum([weights[b] for b in found]) / len(found)
            out.append(value)
        return np.array(out, np.float32)[:, None]

    table = WordTable(rows, 1)

    def score(texts: list[str | None]):
        if model.constant is not None:
            return [[model.constant] * len(texts), [int(model.constant >= threshold)] * len(texts)]
        scores = []
        for found, counts, _ in slices([t or "" for t in texts]):
            logits = segment_sums(table.take(found), counts)[:, 0] / np.maximum(counts, 1) + model.bias
            scores.append(1 / (1 + np.exp(-np.clip(logits, -60, 60))))
        scores = np.concatenate(scores)
        return [scores, (scores >= threshold).astype(np.int32)]

    return score


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted of every row of (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers
    return score_texts(docs, lambda: _scorer(shared.value, threshold), "score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1, most: int = SAMPLE) -> DataFrame:
    """Fit on labels.toxic outside the held-out fold, score all: doc_id, held_out, score, predicted."""
    held_out = fold(F.col("doc_id"), folds, held)
    model = fit(labelled_sample(docs, labels, "toxic", ~held_out, most))
    return score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")

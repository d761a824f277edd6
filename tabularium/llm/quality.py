"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of PASSAGE words (the last may be shorter); every passage of the whole text is encoded.
A run of non-space longer than PART counts as several words, its pieces of PART characters (the last may be shorter).
The encoding is the mean over its words of fixed features (shapes of the word and signed hashes of its letter trigrams),
with the share of distinct words. Gated attention, a_k ~ exp(w . (tanh(V h_k) * sigmoid(U h_k))), and a linear head on
the attention-weighted mean of the passages are learnt together from the documents' labels by Adam in numpy.

Defined results: a null text counts as empty, and an empty text is one passage of zeros. With nothing to learn from, or
one class only, every score is the share of label 1 among the labelled documents there are, else 0.5. Repeated rows are
scored alike. Texts of any length are read whole, in as many passages as they have. A score that equals the threshold
counts as label 1. Of several labels of one doc_id the larger counts, of several texts the one that sorts first is learnt
from; a null doc_id is scored but not learnt from. Columns besides doc_id, text and the label are ignored, whatever their
names. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import WordTable, fold, labelled_sample, score_texts, segment_sums, slices

PASSAGE = 64
HASHED = 20
SHAPES = 12
WIDTH = HASHED + SHAPES + 2
HIDDEN = 16
#: Labelled documents of each class that the model is fitted on, at most about.
SAMPLE = 2000
THRESHOLD = 0.3
#: Longer runs of non-space, as in texts without spaces, are cut into pieces of so many characters.
PART = 40
LATIN = re.compile(r"[^\W\d_]")


def word_features(words: list[str]) -> np.ndarray:
    """Fixed features of each word; none depends on the data."""
    out = np.zeros((len(words), HASHED + SHAPES), np.float32)
    for row, w in zip(out, words):
        n = len(w)
        letters = len(LATIN.findall(w))
        digits = sum(map(str.isdigit, w))
        row[0] = min(n, 20) / 10
        row[1] = n > 20
        row[2] = letters / n
        row[3] = digits / n
        row[4] = (n - letters - digits) / n
        row[5] = w.isupper()
        row[6] = w.istitle()
        row[7] = w[-1] in ".,;:?!"
        row[8] = w[-1] in "!?" and n > 1 and w[-2] == w[-1]
        row[9] = letters == 0
        row[10] = n - letters - digits > 2
        row[11] = n <= 3
        core = f"<{w.lower()}>"
        for i in range(len(core) - 2):
            h = zlib.crc32(core[i : i + 3].encode("utf-8", "replace"))
            row[SHAPES + h % HASHED] += 0.5 if h & 0x10000 else -0.5
    return out


def encode(words: WordTable, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Passages of texts, one under the other, and how many each text has."""
    bags, sizes = [], []
    for found, counts, n in slices(texts, PART):
        at = words.of(found)
        passages = np.maximum(-(-counts // PASSAGE), 1)
        lengths = np.full(passages.sum(), PASSAGE)
        ends = np.cumsum(passages) - 1
        lengths[ends] = counts - (passages - 1) * PASSAGE
        sums = segment_sums(words.rows[at], lengths) / np.maximum(lengths, 1)[:, None]
        owner = np.repeat(np.arange(len(lengths)), lengths)
        distinct = np.zeros(len(lengths))
        if len(at):
            order = np.lexsort((at, owner))
            a, o = at[order], owner[order]
            first = np.concatenate([[True], (a[1:] != a[:-1]) | (o[1:] != o[:-1])])
            distinct = np.bincount(o[first], minlength=len(lengths)) / np.maximum(lengths, 1)
        bags.append(np.column_stack([sums, distinct, np.minimum(lengths, PASSAGE) / PASSAGE]))
        sizes.append(passages)
    return (np.concatenate(bags), np.concatenate(sizes)) if bags else (np.zeros((0, WIDTH)), np.zeros(0, int))


@dataclass
class Model:
    mean: np.ndarray
    spread: np.ndarray
    v: np.ndarray
    u: np.ndarray
    w: np.ndarray
    head: np.ndarray
    bias: np.ndarray
    constant: float | None = None

    def forward(self, passages: np.ndarray, sizes: np.ndarray) -> dict:
        starts = np.cumsum(sizes) - sizes
        owner = np.repeat(np.arange(len(sizes)), sizes)
        tanh = np.tanh(passages @ self.v)
        gate = 1 / (1 + np.exp(-np.clip(passages @ self.u, -50, 50)))
        raw = (tanh * gate) @ self.w
        raw = np.exp(raw - np.maximum.reduceat(raw, starts)[owner])
        attention = raw / np.add.reduceat(raw, starts)[owner]
        pooled = np.add.reduceat(attention[:, None] * passages, starts, axis=0)
        logit = pooled @ self.head + self.bias[0]
        return {"owner": owner, "starts": starts, "tanh": tanh, "gate": gate, "attention": attention, "pooled": pooled, "score": 1 / (1 + np.exp(-np.clip(logit, -50, 50)))}


def fit(sample: list[tuple[str, int]], share: float | None = None, epochs: int = 60, rate: float = 0.02, decay: float = 1e-4, seed: int = 5) -> Model:
    """``share``: of label 1 among all labelled documents, to which the loss is weighted whatever the sample has."""
    y = np.array([v for _, v in sample], float)
    rng = np.random.default_rng(seed)
    start = [rng.normal(0, 0.1, s) for s in ((WIDTH, HIDDEN), (WIDTH, HIDDEN), (HIDDEN,), (WIDTH,))]
    if len(set(y)) < 2:
        return Model(np.zeros(WIDTH), np.ones(WIDTH), *start, np.zeros(1), float(y.mean()) if len(y) else 0.5)
    passages, sizes = encode(WordTable(word_features, HASHED + SHAPES), [t for t, _ in sample])
    mean, spread = passages.mean(0), passages.std(0) + 1e-3
    passages = (passages - mean) / spread
    model = Model(mean, spread, *start, np.zeros(1))
    share = y.mean() if share is None else share
    weight = np.where(y == 1, share / (y == 1).sum(), (1 - share) / (y == 0).sum()) * len(y)
    begins = np.cumsum(sizes) - sizes
    params = [model.v, model.u, model.w, model.head, model.bias]
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in params]
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(y), 128):
            own = order[at : at + 128]
            rows = np.concatenate([np.arange(begins[i], begins[i] + sizes[i]) for i in own])
            x = passages[rows]
            f = model.forward(x, sizes[own])
            delta = (f["score"] - y[own]) * weight[own] / len(own)
            grad_head = f["pooled"].T @ delta
            value = x @ model.head  # what each passage would add to the logit
            drift = f["attention"] * (value - (f["pooled"] @ model.head)[f["owner"]]) * delta[f["owner"]]
            inner = drift[:, None] * model.w
            grads = [x.T @ (inner * f["gate"] * (1 - f["tanh"] ** 2)), x.T @ (inner * f["tanh"] * f["gate"] * (1 - f["gate"])), (f["tanh"] * f["gate"]).T @ drift, grad_head, np.array([delta.sum()])]
            step += 1
            for p, g, m in zip(params, grads, moments):
                g = g + decay * p
                m[0] *= 0.9
                m[0] += 0.1 * g
                m[1] *= 0.999
                m[1] += 0.001 * g * g
                p -= rate * (1 - epoch / epochs) * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.999**step)) + 1e-8)
    return model


def _scorer(model: Model, threshold: float):
    words = WordTable(word_features, HASHED + SHAPES)

    def score(texts: list[str | None]):
        if model.constant is not None:
            return [[model.constant] * len(texts), [int(model.constant >= threshold)] * len(texts)]
        scores = []
        for k in range(0, len(texts), 256):
            passages, sizes = encode(words, [t or "" for t in texts[k : k + 256]])
            scores.append(model.forward((passages - model.mean) / model.spread, sizes)["score"])
        scores = np.concatenate(scores)
        return [scores, (scores >= threshold).astype(np.int32)]

    return score


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted of every row of (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # some thousand numbers
    return score_texts(docs, lambda: _scorer(shared.value, threshold), "score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0, most: int = SAMPLE) -> DataFrame:
    """Fit on labels.quality outside the held-out fold, score all: doc_id, held_out, score, predicted."""
    held_out = fold(F.col("doc_id"), folds, held)
    counts = labels.where(F.col("quality").isin(0, 1) & ~held_out).agg(F.avg("quality")).first()[0]
    model = fit(labelled_sample(docs, labels, "quality", ~held_out, most), counts)
    return score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")

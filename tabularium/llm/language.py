"""Language ID: unigram pieces with the segmentation marginalised.

Each language has probabilities of the pieces of a fixed public vocabulary. The probability of a word (a run of letters,
lower-cased, with the mark of a word's start) is the sum over all its segmentations, by the forward algorithm; EM with
forward-backward counts learns the pieces' probabilities. A text's probability is the product over its words, and the
prediction is the language with the largest posterior.

Defined results: a null text, and one without a letter, is ``und`` with score 0. Characters that the vocabulary lacks
have one small probability in all languages. Nothing to learn from: every text is ``und``. Ties go to the language that
sorts first. Repeated rows are scored alike. Words of any length are scored whole; EM learns from parts of LONG letters of
longer ones. Rows without lang are not learnt from. An empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import clean_text, parts, worker_keep
from .words import TABLE, WordTable, fold, score_texts, segment_sums, slices, thin

LETTERS = regex.compile(r"\p{L}+")
START = "▁"
UNKNOWN = 1e-7
#: No language: the name that a text gets which is no likelier in any language than by chance.
CHANCE = "\0"
#: Words longer than this are summed with rescaling, one at a time; EM learns from their parts of so many letters.
LONG = 40
#: Documents of each language that the model is fitted on, at most about.
SAMPLE = 600
#: Words that a worker keeps in a stage of the pipeline, whose executors hold other stages' things too.
STAGE_TABLE = 250_000


def vocabulary(path: str) -> list[str]:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return sorted({p for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)) for p in [model.id_to_piece(i)] if START not in p[1:]})


class Lattice:
    """Finds the pieces in words by a trie, at all starts of many words at once."""

    def __init__(self, pieces: list[str]):
        self.size = len(pieces)
        self.longest = max(map(len, pieces), default=1)
        states = {"": 0} | {p: k for k, p in enumerate(sorted({p[:k] for p in pieces for k in range(1, len(p) + 1)}), 1)}
        arcs = sorted((states[p[:-1]] << 21 | ord(p[-1]), k) for p, k in states.items() if p)
        self.arcs = np.array([a for a, _ in arcs] + [1 << 62], np.int64)
        self.targets = np.array([k for _, k in arcs] + [0], np.int64)
        self.piece = np.full(len(states), -1, np.int32)  # -1: a mere beginning of pieces
        self.piece[[states[p] for p in pieces]] = np.arange(len(pieces))

    def of(self, words: list[str]) -> np.ndarray:
        """Ids [word, start, length - 1] for words of one length; ``size`` stands for none, ``size + 1`` for unknown."""
        n, t = len(words), len(words[0])
        chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        out = np.full((n * t, min(self.longest, t)), self.size, np.int32)
        start, state, room = np.arange(n * t), np.zeros(n * t, np.int64), np.tile(np.arange(t, 0, -1), n)
        for k in range(out.shape[1]):
            inside = room > k
            start, state, room = start[inside], state[inside], room[inside]
            arc = state << 21 | chars[start + k]
            at = np.searchsorted(self.arcs, arc)
            on = self.arcs[at] == arc
            start, state, room = start[on], self.targets[at[on]], room[on]
            if not len(start):
                break
            found = self.piece[state]
            out[start[found >= 0], k] = found[found >= 0]
        out[out[:, 0] == self.size, 0] = self.size + 1
        return out.reshape(n, t, -1)


def forward(ids: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Sums over all segmentations of each beginning: [word, end, language]."""
    n, t, most = ids.shape
    alpha = np.zeros((n, t + 1, table.shape[1]))
    alpha[:, 0] = 1
    for end in range(1, t + 1):
        for m in range(1, min(most, end) + 1):
            alpha[:, end] += alpha[:, end - m] * table[ids[:, end - m, m - 1]]
    return alpha


def log_forward(ids: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Logarithms of the sums for one word of any length, rescaled as they go."""
    _, t, most = ids.shape
    alpha, scale = np.zeros((most + 1, table.shape[1])), np.zeros(table.shape[1])
    alpha[0] = 1  # alpha[k]: the sum of the beginning that ends k letters before this one
    for end in range(1, t + 1):
        new = sum(alpha[m - 1] * table[ids[0, end - m, m - 1]] for m in range(1, min(most, end) + 1))
        alpha = np.concatenate([new[None], alpha[:-1]])
        top = np.maximum(alpha.max(0), 1e-300)
        alpha, scale = alpha / top, scale + np.log(top)
    return np.log(np.maximum(alpha[0], 1e-300)) + scale


def word_logs(words: list[str], lattice: Lattice, table: np.ndarray) -> np.ndarray:
    out = np.zeros((len(words), table.shape[1]))
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    for length, group in groupby(order, key=lambda i: len(words[i])):
        at = [*group]
        for k in range(0, len(at), 4096):
            part = at[k : k + 4096]
            if length > LONG:
                for i in part:
                    out[i] = log_forward(lattice.of([words[i]]), table)
            else:
                out[part] = np.log(np.maximum(forward(lattice.of([words[i] for i in part]), table)[:, -1], 1e-300))
    return out


def fit_pieces(words: dict[str, int], lattice: Lattice, rounds: int = 4, smooth: float = 0.05) -> np.ndarray:
    """Piece probabilities of one language by EM. The last two entries: none, unknown."""
    v = lattice.size
    parts: dict[str, int] = {}
    for word, n in words.items():
        for k in range(0, len(word), LONG):
            parts[word[k : k + LONG]] = parts.get(word[k : k + LONG], 0) + n
    p = np.full(v + 2, 1.0 / max(v, 1))
    p[v], p[v + 1] = 0, UNKNOWN
    groups = []
    for _, group in groupby(sorted(parts, key=len), key=len):
        own = [*group]
        groups.append((lattice.of(own), np.array([parts[w] for w in own], float)))
    for _ in range(rounds):
        counts = np.zeros(v + 2)
        for ids, weight in groups:
            table = p[:, None]
            n, t, most = ids.shape
            alpha = forward(ids, table)[:, :, 0]
            beta = np.zeros((n, t + 1))
            beta[:, t] = 1
            for start in range(t - 1, -1, -1):
                for m in range(1, min(most, t - start) + 1):
                    beta[:, start] += p[ids[:, start, m - 1]] * beta[:, start + m]
            scale = weight / np.maximum(alpha[:, t], 1e-300)
            for start in range(t):
                for m in range(1, min(most, t - start) + 1):
                    i = ids[:, start, m - 1]
                    counts += np.bincount(i, alpha[:, start] * p[i] * beta[:, start + m] * scale, v + 2)
        p[:v] = (counts[:v] + smooth) / (counts[:v].sum() + smooth * v)
    return p


@dataclass
class Model:
    languages: list[str]
    prior: np.ndarray
    pieces: list[str]
    table: np.ndarray  # [piece, language]

    def with_chance(self) -> "Model":
        """With a further language, CHANCE, in which every piece is as likely; it is as frequent as all others together."""
        even = np.full(len(self.table), 1.0 / max(len(self.pieces), 1))
        even[len(self.pieces) :] = self.table[len(self.pieces) :, 0]
        return Model([*self.languages, CHANCE], np.append(self.prior, 0.0), self.pieces, np.column_stack([self.table, even]))

    def scorer(self, most: int = TABLE):
        lattice, width = Lattice(self.pieces), len(self.languages)

        # runs that differ in marks and case share their words
        known = WordTable(lambda new: word_logs(new, lattice, self.table), width, most)

        def rows(runs: list[str]) -> np.ndarray:
            """For a run of non-space: a flag for letters, and the sum of its words' logarithms by language."""
            own = [[START + w for w in LETTERS.findall(r.lower())] for r in runs]
            counts = np.array([*map(len, own)])
            sums = segment_sums(known.take([w for ws in own for w in ws]), counts)
            return np.concatenate([(counts > 0)[:, None], sums], axis=1)

        words = WordTable(rows, width + 1, most)

        def score(texts: list[str | None]):
            names, scores = [], []
            for found, counts, _ in slices([t or "" for t in texts]):
                sums = segment_sums(words.take(found), counts)
                logs = sums[:, 1:] + self.prior
                odds = np.exp(logs - logs.max(1, keepdims=True))
                best, top = odds.argmax(1), odds.max(1) / odds.sum(1)
                some = sums[:, 0] > 0
                names += [self.languages[b] if s else "und" for b, s in zip(best, some)]
                scores += np.where(some, top, 0.0).tolist()
            return [names, scores]

        return score


def fit(docs: DataFrame, learn, vocabulary_path: str, most: int = SAMPLE) -> Model | None:
    """Fit on about ``most`` documents a language (columns doc_id, text, lang) of those that ``learn`` admits."""
    rows = docs.where(F.col("lang").isNotNull() & learn).select("doc_id", "text", "lang")
    priors = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}
    if not priors:
        return None
    sample = thin(rows, "doc_id", "lang", most)
    words = F.explode(F.regexp_extract_all(F.lower(clean_text()), F.lit(r"(\p{L}+)"), 1)).alias("word")
    counts: dict[str, dict[str, int]] = {v: {} for v in sorted(priors)}
    for lang, word, n in sample.select("lang", words).groupBy("lang", "word").count().collect():
        counts[lang][START + word] = n
    pieces = vocabulary(vocabulary_path)
    lattice = Lattice(pieces)
    table = np.stack([fit_pieces(dict(sorted(own.items())), lattice) for own in counts.values()], axis=1)
    total = sum(priors.values())
    return Model([*counts], np.log([priors[v] / total for v in counts]), pieces, table)


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred, score of every row of (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a table of fixed size

    def make():
        model = shared.value
        return model.scorer() if model else lambda texts: [["und"] * len(texts), [0.0] * len(texts)]

    return score_texts(docs, make, "lang_pred string, score double")


def identify(docs: DataFrame, vocabulary_path: str, folds: int = 4, held: int = 2) -> DataFrame:
    """Fit on the rows outside the held-out fold, predict all: doc_id, held_out, lang_pred, score."""
    model = fit(docs, ~fold(F.col("doc_id"), folds, held), vocabulary_path)
    return predict(docs, model).select("doc_id", fold(F.col("doc_id"), folds, held).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, vocabulary_path: str, folds: int = 4, held: int = 2) -> DataFrame:
    """Rows of ``docs`` in one of the languages learnt; a null lang becomes the predicted one, and all columns stay.

    A text is rejected if it is null or has no letter, or if no language explains it better than chance does: that is, if
    pieces of even probability, a further column of the model, have the largest posterior. Each row is decided by its own
    text, in place; rows that repeat a doc_id are decided each. With nothing to learn from, the rows with a letter stay.
    """
    import pyarrow as pa
    import pyarrow.compute as pc

    model = fit(docs.select("doc_id", "text", "lang"), ~fold(F.col("doc_id"), folds, held), vocabulary_path)
    key, shared = uuid.uuid4().hex, docs.sparkSession.sparkContext.broadcast(model and model.with_chance())
    at = docs.columns.index("lang")

    def run(batches):
        model = shared.value
        score = worker_keep(key, lambda: model.scorer(STAGE_TABLE)) if model else None
        for batch in parts(batches):
            texts = batch.column("text").to_pylist()
            if score:
                found = score(texts)[0]
                keep = pa.array([n not in ("und", CHANCE) for n in found], pa.bool_())
                named = pc.coalesce(batch.column("lang"), pa.array(found, batch.column("lang").type))
                batch = batch.set_column(at, batch.schema.field(at), named)
            else:
                keep = pa.array([bool(t and LETTERS.search(t)) for t in texts], pa.bool_())
            yield batch.filter(keep)

    return docs.mapInArrow(run, docs.schema)

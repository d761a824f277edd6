"""Word-wise scoring in Python workers, and bounded labelled samples.

A text is cut at white space; what a model knows of a word is computed once and kept in a table of bounded size, so a
text costs little more than its look-ups. Whole texts are read, a few hundred at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import clean_text, worker_keep

#: Words whose rows a worker keeps; the table is emptied when full.
TABLE = 600_000
#: Words of about so many texts are looked up at once.
SLICE_WORDS = 60_000


class WordTable:
    """Rows of numbers by word. ``compute`` gets a list of new words and returns their rows."""

    def __init__(self, compute: Callable[[list[str]], np.ndarray], width: int, most: int = TABLE):
        self.compute, self.width, self.most = compute, width, most
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.rows = np.zeros((1024, self.width), np.float32)

    def of(self, words: list[str]) -> np.ndarray:
        """Positions in ``rows``, valid until the next call."""
        if len(self.index) > self.most:
            self.clear()
        found = [*map(self.index.get, words)]
        if None in found:
            index, at = self.index, len(self.index)
            new = [w for w in dict.fromkeys(w for w, i in zip(words, found) if i is None)]
            if at + len(new) > len(self.rows):
                grown = np.zeros((2 * (at + len(new)), self.width), np.float32)
                grown[:at] = self.rows[:at]
                self.rows = grown
            self.rows[at : at + len(new)] = self.compute(new)
            index.update(zip(new, range(at, at + len(new))))
            found = [*map(index.__getitem__, words)]
        return np.array(found, np.int64)

    def take(self, words: list[str]) -> np.ndarray:
        at = self.of(words)
        return self.rows[at]


def slices(texts: list[str], part: int | None = None) -> Iterator[tuple[list[str], np.ndarray, int]]:
    """Words of consecutive texts, the number of words of each, and the number of texts; with ``part``, longer words are cut into pieces of so many characters."""
    words, counts = [], []
    for text in texts:
        own = text.split()
        if part and own and max(map(len, own)) > part:
            own = [w[k : k + part] for w in own for k in range(0, len(w), part)]
        words += own
        counts.append(len(own))
        if len(words) > SLICE_WORDS:
            yield words, np.array(counts), len(counts)
            words, counts = [], []
    if counts:
        yield words, np.array(counts), len(counts)


def segment_sums(rows: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of rows; an empty run has sum 0."""
    out = np.zeros((len(counts), *rows.shape[1:]), np.float64)
    full = counts > 0
    if full.any():
        starts = np.cumsum(counts) - counts
        out[full] = np.add.reduceat(rows, starts[full], axis=0, dtype=np.float64)
    return out


def fold(doc_id: Column, folds: int, which: int) -> Column:
    """Whether crc32 of the doc_id as text has remainder ``which``; a null doc_id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == which


def thin(rows: DataFrame, key: str, by: str, most: int) -> DataFrame:
    """About ``most`` rows at most of each value of ``by`` (a few values), by a hash of ``key``: the same rows each time."""
    counts = {v: n for v, n in rows.groupBy(by).count().collect() if v is not None}
    part = F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), F.lit(1 << 20))
    keep = F.lit(False)
    for value, n in counts.items():
        keep = keep | ((F.col(by) == F.lit(value)) & (part < F.lit(int((1 << 20) * min(1.0, most / n)))))
    return rows.where(keep)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, most: int) -> list[tuple[str, int]]:
    """(text, label) of at most about ``most`` documents a class that ``learn`` admits; of contrary labels the larger counts.

    The sampled ids are bounded by about ``2 * most`` and so are broadcast to the scan of the texts. Of several texts of
    one id the one that sorts first counts, so that no more texts than ids come to the driver.
    """
    ids = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & learn).groupBy("doc_id").agg(F.max(label).alias("__tb_label"))
    chosen = thin(ids, "doc_id", "__tb_label", most)
    joined = docs.select("doc_id", clean_text().alias("text")).join(F.broadcast(chosen), "doc_id")
    found = joined.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("__tb_label").alias("__tb_label")).collect()
    return [(t, int(v)) for _, t, v in sorted(found, key=lambda r: r[0])]


def score_texts(docs: DataFrame, make: Callable[[], Callable[[list[str]], list[np.ndarray]]], columns: str) -> DataFrame:
    """doc_id and ``columns`` of every row of (doc_id, text); ``make`` is called once in each Python worker."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import StructType

    key, slim = uuid.uuid4().hex, docs.select("doc_id", F.col("text").cast("string").alias("text"))
    added = StructType.fromDDL(columns)
    names, types = added.fieldNames(), [to_arrow_type(f.dataType) for f in added]

    def run(batches):
        score = worker_keep(key, make)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            made = score(texts) if texts else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(made, types))], names=["doc_id", *names])

    return slim.mapInArrow(run, StructType([slim.schema["doc_id"], *added]))

"""Best-fit packing by patterns: non-negative least squares over short length patterns, best fit for what is left.

Only the histogram of lengths (at most ``capacity`` counts) comes to the driver. ``plan`` enumerates the patterns of up
to three lengths that fill a sequence exactly, fits their repeat counts to the histogram by projected, accelerated
non-negative least squares, rounds them to what is there, and packs the residual histogram by best fit, longest first.
The plan is a bounded table of (length, run of slots -> run of sequences, offset); its size depends on ``capacity``, not
on the number of documents. Pieces find their slots by their place in the order of lengths, which a range partitioning
gives without putting one length into one task.

Defined results: a null or empty text is one piece that holds only the end mark. A text longer than ``capacity`` is cut
into full pieces and a rest. Pieces of equal length may change places; the number of sequences is the same. Repeated rows
are packed as documents of their own, and a null doc_id stays null. Columns besides doc_id and text are ignored, whatever
their names. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import compiled_lexicon, worker_encoder
from .common import clean_text, parts, stash

CAPACITY = 2048
END_MARK = b"\0\0\0\0"


def exact_patterns(present: np.ndarray, capacity: int) -> np.ndarray:
    """Patterns a <= b <= c of present lengths with a + b + c = capacity; a is 0 in patterns of two."""
    have = np.zeros(capacity + 1, bool)
    have[present] = True
    found = []
    for a in [0, *present[present <= capacity // 3].tolist()]:
        b = np.arange(max(a, 1), (capacity - a) // 2 + 1)
        b = b[have[b] & have[capacity - a - b]]
        found.append(np.stack([np.full_like(b, a), b, capacity - a - b], 1))
    return np.concatenate(found) if found else np.zeros((0, 3), np.int64)


def fit_repeats(patterns: np.ndarray, histogram: np.ndarray, steps: int = 300) -> np.ndarray:
    """Repeat counts x >= 0 that minimise |A x - histogram|; A has a one for each use of a length by a pattern."""
    n = len(patterns)
    if not n:
        return np.zeros(0)
    size = len(histogram)
    uses = lambda x: sum(np.bincount(patterns[:, j], x, size) for j in range(3)) * (np.arange(size) > 0)
    target = histogram.astype(float) * (np.arange(size) > 0)
    total = max(target.sum(), 1.0)
    target = target / total
    back = lambda r: r[patterns[:, 0]] + r[patterns[:, 1]] + r[patterns[:, 2]]
    v = np.ones(n)
    for _ in range(12):  # the largest eigenvalue of A'A sets the step
        v = back(uses(v))
        v /= np.linalg.norm(v)
    step = 1 / (1.05 * np.linalg.norm(back(uses(v))))
    x = y = np.zeros(n)
    t = 1.0
    for _ in range(steps):
        new = np.maximum(y - step * back(uses(y) - target), 0)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t2 * (new - x)
        x, t = new, t2
    return x * total


@dataclass
class Plan:
    """Runs of slots, ordered by length and first slot; ``starts`` counts all shorter pieces too."""

    starts: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int


def plan(histogram: np.ndarray, capacity: int = CAPACITY) -> Plan:
    """histogram[l]: pieces of length l, for l from 0 to ``capacity`` (none has length 0)."""
    left = histogram.astype(np.int64).copy()
    recipes: list[tuple[int, list[int]]] = []
    if left[capacity]:
        recipes.append((int(left[capacity]), [capacity]))
        left[capacity] = 0
    patterns = exact_patterns(np.flatnonzero(left), capacity)
    x = fit_repeats(patterns, left)
    for i in np.argsort(-x, kind="stable")[: int((x > 0.02).sum())]:
        lengths = [int(v) for v in patterns[i] if v]
        want = max(1, int(np.floor(x[i] + 0.5)))
        k = min(want, *(int(left[v]) // lengths.count(v) for v in lengths))
        if k:
            recipes.append((k, lengths))
            for v in lengths:
                left[v] -= k
    recipes += best_fit(left, capacity)
    used = np.zeros(capacity + 1, np.int64)
    before = np.concatenate([[0], np.cumsum(histogram.astype(np.int64))[:-1]])
    starts, sequence, offset, first = [], [], [], 0
    for k, lengths in recipes:
        at = 0
        for v in lengths:
            starts.append(before[v] + used[v])
            sequence.append(first)
            offset.append(at)
            used[v] += k
            at += v
        first += k
    order = np.argsort(np.array(starts, np.int64), kind="stable")
    return Plan(*(np.array(c, np.int64)[order] for c in (starts, sequence, offset)), first)


def best_fit(histogram: np.ndarray, capacity: int) -> list[tuple[int, list[int]]]:
    """Best fit, longest first, on counts: (repeats, lengths)."""
    bins: dict[int, list[tuple[int, list[int]]]] = {}  # free space -> groups of like sequences
    spaces = np.zeros(capacity + 1, bool)
    for v in np.flatnonzero(histogram)[::-1].tolist():
        left = int(histogram[v])
        while left:
            fits = v + int(np.argmax(spaces[v:]))
            if not spaces[fits]:
                each = capacity // v
                for k, n in ((left // each, each), (1, left % each)):
                    if k and n:
                        bins.setdefault(capacity - n * v, []).append((k, [v] * n))
                        spaces[capacity - n * v] = True
                break
            k, lengths = bins[fits].pop()
            take = min(k, left)
            if take < k:
                bins[fits].append((k - take, lengths))
            spaces[fits] = bool(bins[fits])
            bins.setdefault(fits - v, []).append((take, [*lengths, v]))
            spaces[fits - v] = True
            left -= take
    return [g for groups in bins.values() for g in groups]


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of the ids of each text and its end mark, cut at ``capacity``."""
    import pyarrow as pa
    from pyspark.sql.types import StructType

    shared = docs.sparkSession.sparkContext.broadcast(compiled_lexicon(tokenizer))
    slim = docs.select("doc_id", clean_text().alias("text"))
    schema = StructType([slim.schema["doc_id"], *StructType.fromDDL("piece int, start long, length long, ids_crc32 long")])

    def run(batches):
        encoder = worker_encoder(tokenizer, shared.value)
        for batch in parts(batches):
            row, piece, length, crc = [], [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                ids = encoder.encode(text) + END_MARK
                for p, at in enumerate(range(0, len(ids), 4 * capacity)):
                    cut = ids[at : at + 4 * capacity]
                    row.append(i)
                    piece.append(p)
                    length.append(len(cut) // 4)
                    crc.append(zlib.crc32(cut))
            piece = np.array(piece, np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece), pa.array(piece.astype(np.int64) * capacity), pa.array(length, pa.int64()), pa.array(crc, pa.int64())], names=schema.fieldNames()
            )

    return slim.mapInArrow(run, schema)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to pieces (doc_id, piece, length, ...)."""
    import pyarrow as pa
    from pyspark import TaskContext
    from pyspark.sql.types import LongType, StructField, StructType

    spark = pieces.sparkSession
    pieces = stash(pieces, "pieces")
    histogram = np.zeros(capacity + 1, np.int64)
    for length, n in pieces.groupBy("length").count().collect():
        histogram[length] = n
    made = plan(histogram, capacity)

    def number(batches):
        """A row's partition and its place there."""
        part, seen = TaskContext.get().partitionId(), 0
        for b in batches:
            n = b.num_rows
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(n, part)), pa.array(np.arange(seen, seen + n))], names=[*b.schema.names, "__tb_part", "__tb_row"])
            seen += n

    order = ["length", "doc_id", "piece", "__tb_tie"]
    tasks = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = pieces.withColumn("__tb_tie", F.monotonically_increasing_id()).repartitionByRange(tasks, *order).sortWithinPartitions(*order).drop("__tb_tie")
    places = [StructField("__tb_part", LongType()), StructField("__tb_row", LongType())]
    numbered = stash(dealt.mapInArrow(number, StructType([*pieces.schema, *places])), "numbered")
    counts = dict(numbered.groupBy("__tb_part").count().collect())  # one row for each partition
    before, seen = {}, 0
    for part in sorted(counts):
        before[part] = seen
        seen += counts[part]
    shared, names = spark.sparkContext.broadcast((before, made)), pieces.columns

    def place(batches):
        before, made = shared.value
        for b in batches:
            if not b.num_rows:
                continue
            part = b.column("__tb_part").to_numpy()
            rank = b.column("__tb_row").to_numpy() + np.array([before[p] for p in part.tolist()], np.int64)
            run = np.searchsorted(made.starts, rank, "right") - 1
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(made.sequence[run] + rank - made.starts[run]), pa.array(made.offset[run])], names=[*names, "sequence_id", "offset"])

    return numbered.mapInArrow(place, StructType([*pieces.schema, StructField("sequence_id", LongType()), StructField("offset", LongType())]))


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of (doc_id, text)."""
    return pack(token_pieces(docs, tokenizer, capacity), capacity)

"""Vector codes: integer product quantisation, nearest entries found behind segment-mean lower bounds.

A component x becomes floor(1024 * x). A vector is cut into PARTS equal parts; each part position has a codebook of up to
ENTRIES entries, which ROUNDS rounds of assignment and flooring means refine. For a block of m components with means p, q
and residual norms r, s, the squared distance is at least m * (p - q)**2 + (r - s)**2 (the residuals are orthogonal to the
means, and two vectors differ by at least the difference of their norms). The bound of one block over the whole part is
computed for all entries; entries whose bound exceeds the exact distance to the most promising one go, the others get the
tighter bounds of two and of four blocks, and what survives gets exact integer distances. The bounds are lowered by more
than the rounding of floating point can add, so no nearest entry is ever filtered.

Spark partitions the vectors; a task sends one row of sums for each entry that it met, whatever its rows, and the driver
holds nothing but the codebooks (PARTS * ENTRIES entries) and those merged sums.

Defined results: rows whose vector is null or holds null, NaN or infinite components are dropped. A null vec_id sorts after
all others; of rows that repeat a vec_id each may become an entry, smaller vectors first. With fewer rows than ENTRIES there
are fewer entries. Ties go to the lower entry. An empty table gives an empty result. Kept vectors must have the length of
the first one, a multiple of PARTS, else ValueError. Components too large for 62-bit distances take Python's integers. Other
columns, whatever their names, are ignored; a table without a label column counts as one whose labels are null.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lookup, stash, worker_release

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Blocks of a part at each level of the bounds.
LEVELS = (1, 2, 4)
#: Integer components up to this size, in parts of up to WIDE components, keep squared distances below 2**62.
SMALL, WIDE = 1 << 25, 1 << 10
#: Vectors that are compared with a codebook at once.
SLICE = 1024


def usable(vector: str) -> Column:
    inf = float("inf")
    return F.col(vector).isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (x != inf) & (x != -inf))


def integers(column, width: int) -> np.ndarray:
    """(rows, width) integers of an Arrow column of usable vectors; Python's where they are large."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths != width).any():
        raise ValueError(f"a vector of {int(lengths[lengths != width][0])} components among vectors of {width}")
    scaled = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE).reshape(len(lengths), width)
    if not np.isfinite(scaled).all():
        raise ValueError("a component beyond the range of double precision")
    if width // PARTS <= WIDE and np.abs(scaled).max(initial=0) <= SMALL:
        return scaled.astype(np.int64)
    return np.array([[int(x) for x in row] for row in scaled], object).reshape(len(lengths), width)


def _levels(x: np.ndarray) -> list[list[tuple[int, np.ndarray, np.ndarray]]]:
    """For each level its blocks: components, means and residual norms of all rows."""
    out = []
    for blocks in LEVELS:
        if blocks <= max(1, x.shape[1]):
            parts = np.array_split(x.astype(np.float64), blocks, axis=1)
            means = [p.mean(1) if p.shape[1] else np.zeros(len(x)) for p in parts]
            out.append([(p.shape[1], m, np.sqrt(((p - m[:, None]) ** 2).sum(1))) for p, m in zip(parts, means)])
    return out


def _lowered(bound: np.ndarray) -> np.ndarray:
    return bound * (1 - 1e-6) - 1


def nearest(x: np.ndarray, book: np.ndarray, book_levels=None) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of ``book`` for each row of ``x``, the lower of equals, and the squared distance."""
    if x.dtype == object or book.dtype == object:
        found = [min((sum((int(a) - int(b)) ** 2 for a, b in zip(row, entry)), k) for k, entry in enumerate(book)) for row in x]
        return np.array([k for _, k in found], np.int64), np.array([d for d, _ in found], object)
    own, theirs = _levels(x), book_levels or _levels(book)
    bound = np.zeros((len(x), len(book)))
    for (m, p, r), (_, q, s) in zip(own[0], theirs[0]):
        bound += m * (p[:, None] - q) ** 2 + (r[:, None] - s) ** 2
    guess = book[bound.argmin(1)]
    upper = ((x - guess) ** 2).sum(1)
    row, entry = np.nonzero(_lowered(bound) <= upper[:, None])
    for mine, other in zip(own[1:], theirs[1:]):
        bound = np.zeros(len(row))
        for (m, p, r), (_, q, s) in zip(mine, other):
            bound += m * (p[row] - q[entry]) ** 2 + (r[row] - s[entry]) ** 2
        kept = _lowered(bound) <= upper[row]
        row, entry = row[kept], entry[kept]
    exact = ((x[row] - book[entry]) ** 2).sum(1)
    starts = np.searchsorted(row, np.arange(len(x)))
    least = np.minimum.reduceat(exact, starts) if len(x) else exact
    # rows come in order and entries within them too: the first that reaches the least is the lowest
    hits = np.nonzero(exact == least[row])[0]
    first = hits[np.searchsorted(row[hits], np.arange(len(x)))] if len(x) else hits
    return entry[first], least


def _assigned(vectors: np.ndarray, books: list[np.ndarray], levels: list) -> tuple[np.ndarray, np.ndarray]:
    """(rows, PARTS) codes and distances."""
    each = [nearest(x, book, level) for x, book, level in zip(np.split(vectors, PARTS, axis=1), books, levels)]
    return np.stack([c for c, _ in each], 1), np.stack([d for _, d in each], 1)


def _sliced(batch, name: str, width: int):
    for at in range(0, batch.num_rows, SLICE):
        part = batch.slice(at, SLICE)
        yield part, integers(part.column(name), width)


def _book_levels(books: list[np.ndarray]) -> list:
    return [None if b.dtype == object else _levels(b) for b in books]


def entry_sums(vectors: DataFrame, vector: str, width: int, books: list[np.ndarray]) -> DataFrame:
    """(part, entry, n, sums): the vectors assigned to each entry; sums as decimals, merged over all tasks."""
    import pyarrow as pa

    def run(batches):
        worker_release()
        levels, sums, counts = _book_levels(books), {}, {}
        for batch in batches:
            for _, x in _sliced(batch, vector, width):
                codes, _ = _assigned(x, books, levels)
                for p, part in enumerate(np.split(x, PARTS, axis=1)):
                    for entry in np.unique(codes[:, p]):
                        mine = part[codes[:, p] == entry]
                        key = p, int(entry)
                        counts[key] = counts.get(key, 0) + len(mine)
                        sums[key] = [a + int(b) for a, b in zip(sums.get(key, [0] * mine.shape[1]), mine.sum(0))]
        keys = [*counts]
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()), pa.array([counts[k] for k in keys], pa.int64()), pa.array([[*map(str, sums[k])] for k in keys], pa.list_(pa.string()))],
            names=["part", "entry", "n", "sums"],
        )

    met = vectors.select(vector).mapInArrow(run, "part int, entry int, n long, sums array<string>")
    each = met.select("part", "entry", "n", F.posexplode("sums").alias("at", "x"))
    summed = each.groupBy("part", "entry", "at").agg(F.sum(F.col("x").cast("decimal(38,0)")).cast("string").alias("x"), F.sum("n").alias("n"))
    return summed.groupBy("part", "entry").agg(F.max("n").alias("n"), F.transform(F.array_sort(F.collect_list(F.struct("at", "x"))), lambda s: s["x"]).alias("sums"))


def _packed(rows: list[list[int]]) -> np.ndarray:
    small = all(abs(x) <= SMALL for row in rows for x in row) and (not rows or len(rows[0]) <= WIDE)
    return np.array(rows, np.int64 if small else object).reshape(len(rows), len(rows[0]) if rows else 0)


def codebooks(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", rounds: int = ROUNDS) -> tuple[list[np.ndarray], int]:
    """The entries of each part after ``rounds`` rounds, and the length of the vectors; no entries without vectors."""
    import pyarrow as pa

    first = [r[0] for r in vectors.orderBy(F.col(key).asc_nulls_last(), vector).select(F.col(vector).cast("array<double>")).limit(ENTRIES).collect()]
    if not first:
        return [], 0
    width = len(first[0])
    if width % PARTS:
        raise ValueError(f"vectors of {width} components have no {PARTS} equal parts")
    whole = integers(pa.array(first, pa.list_(pa.float64())), width)
    books = [_packed([[int(x) for x in row] for row in part]) for part in np.split(whole, PARTS, axis=1)]
    for _ in range(rounds if width else 0):
        new = [[[int(x) for x in row] for row in book] for book in books]
        for r in entry_sums(vectors, vector, width, books).collect():  # at most PARTS * ENTRIES rows
            new[r.part][r.entry] = [int(s) // r.n for s in r.sums]
        books = [_packed(b) for b in new]
    return books, width


def _digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for book in books for entry in book for x in entry).encode()).hexdigest()


def encode(vectors: DataFrame, books: list[np.ndarray], width: int, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vectors`` without the vector column, with code (two hex digits a part) and error (squared distance, all parts)."""
    import pyarrow as pa
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    names = [c for c in vectors.columns if c != vector]

    def run(batches):
        worker_release()
        levels = _book_levels(books)
        for batch in batches:
            for part, x in _sliced(batch, vector, width):
                codes, far = _assigned(x, books, levels)
                made = [pa.array(["".join(f"{c:02x}" for c in row) for row in codes.tolist()], pa.string()), pa.array([sum(map(int, row)) for row in far], pa.int64())]
                yield pa.RecordBatch.from_arrays([*map(part.column, names), *made], names=[*names, "code", "error"])

    return vectors.mapInArrow(run, StructType([*(vectors.schema[c] for c in names), StructField("code", StringType()), StructField("error", LongType())]))


def compress(table: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``key``, code, error, label_error (errors of equal labels, nulls together), codebooks_sha256 of each usable row."""
    named = F.col(label) if label in table.columns else F.lit(None)
    # as text, for equal labels must meet in a join, nulls among them
    kept = table.where(usable(vector)).select(F.col(key), F.coalesce(F.concat(F.lit("="), named.cast("string")), F.lit("")).alias("__tb_label"), F.col(vector))
    books, width = codebooks(kept, key, vector)
    coded = stash(encode(kept, books or [np.zeros((0, 0), np.int64)] * PARTS, width, key, vector), "codes")
    total = F.sum(F.col("error").cast("decimal(38,0)")).cast("long")
    groups = coded.groupBy("__tb_label").agg(total.alias("label_error"), F.count("*").alias("__tb_size"))
    found = lookup(coded, groups, "__tb_label", "__tb_size", coded.count())
    return found.select(key, "code", "error", "label_error", F.lit(_digest(books)).alias("codebooks_sha256"))

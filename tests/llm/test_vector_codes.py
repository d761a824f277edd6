import hashlib
import math
import random

import numpy as np
import pytest

from tabularium.llm import vector_codes as V

SCHEMA = "vec_id long, embedding array<double>, label int, code string"


def brute(rows, parts=4, entries=256, rounds=4):
    kept = sorted((i, v, lab) for i, v, lab, _ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v))
    ints = [[math.floor(1024 * x) for x in v] for _, v, _ in kept]
    w = len(ints[0]) // parts
    cut = lambda v, p: v[p * w : (p + 1) * w]
    books = [[cut(v, p) for v in ints[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda v, p: min((far(cut(v, p), e), k) for k, e in enumerate(books[p]))
    for _ in range(rounds):
        new = [list(b) for b in books]
        for p in range(parts):
            met = {}
            for v in ints:
                met.setdefault(nearest(v, p)[1], []).append(cut(v, p))
            for k, own in met.items():
                new[p][k] = [sum(c) // len(own) for c in zip(*own)]
        books = new
    out, errors = {}, {}
    for (i, _, lab), v in zip(kept, ints):
        found = [nearest(v, p) for p in range(parts)]
        out[i] = ("".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), lab)
        errors[lab] = errors.get(lab, 0) + out[i][1]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return {i: (c, e, errors[lab], sha) for i, (c, e, lab) in out.items()}


def vectors(n, width=8, seed=3, scale=1.0):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(9)]
    rows = [(i, [c + rng.gauss(0, 0.2) * scale for c in rng.choice(centres)], rng.choice([None, 1, 2]), "x") for i in range(n)]
    rows += [(n, list(rows[0][1]), 1, None), (n + 1, None, 1, "x"), (n + 2, [None] * width, 1, "x"), (n + 3, [float("nan")] * width, 2, "x"), (n + 4, [float("inf")] + [0.0] * (width - 1), 2, "x")]
    return rows


def got(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return {r.vec_id: (r.code, r.error, r.label_error, r.codebooks_sha256) for r in V.compress(df).collect()}


@pytest.mark.parametrize("rows", [vectors(400), vectors(20), vectors(300, 4, scale=0.001), [(i, [1.0] * 8, None, "") for i in range(5)], vectors(30, 8, scale=1e6)])
def test_codes_equal_brute_force(spark, rows):
    assert got(spark, rows) == brute(rows)


def test_bounds_never_lose_the_nearest():
    rng = np.random.default_rng(1)
    for width, size in ((1, 5), (3, 40), (16, 3000), (16, 1 << 25), (7, 2)):
        x, book = rng.integers(-size, size + 1, (200, width)), rng.integers(-size, size + 1, (64, width))
        codes, far = V.nearest(x, book)
        exact = ((x[:, None].astype(object) - book) ** 2).sum(2)
        assert codes.tolist() == [min(range(64), key=lambda k: (row[k], k)) for row in exact] and far.tolist() == [min(row) for row in exact]


def test_odd_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert V.compress(empty).collect() == [] and V.compress(empty).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert got(spark, [(1, None, 1, "x")]) == {}
    assert [r.error for r in V.compress(spark.createDataFrame([(None, [1.0] * 4), (None, [1.0] * 4)], "vec_id long, embedding array<float>")).collect()] == [0, 0]
    for bad in ([(1, [1.0] * 8, 1, ""), (2, [1.0] * 4, 1, "")], [(1, [1.0] * 3, 1, "")]):
        with pytest.raises(Exception, match="components"):
            got(spark, bad)

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabularium.llm import minhash as M

SCHEMA = "doc_id long, text string, n long, class string"


def shingle_set(text):
    words = (text or "").encode().lower().split()
    grams = [tuple(words[i : i + 4]) for i in range(len(words) - 3)] if len(words) > 4 else [tuple(words)] if words else []
    return set(grams)


def brute(rows):
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted((d, len(s), least.get(find(i)), d == least.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets)) if d is not None)


def got(spark, rows, parts=3):
    df = spark.createDataFrame([(d, t, 7, "x") for d, t in rows], SCHEMA).repartition(parts)
    return sorted(tuple(r) for r in M.near_duplicates(df).collect() if r.doc_id is not None)


def corpus(n, seed, words=120):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(5, words))] for _ in range(n // 6)]
    rows = []
    for i in range(n):
        own = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 4, 9])):  # similarities on both sides of the threshold, chains among them
            own[rng.randrange(len(own))] = rng.choice(vocabulary)
        text = " ".join(own)
        rows.append((i * 3, rng.choice([text, text.upper(), text.replace(" ", "\t\n ", 3)])))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_equal_brute_force(spark, seed):
    rows = corpus(240, seed) + [(1, None), (2, ""), (4, " \n"), (5, "a b c d"), (7, "A  B c D"), (8, "a b c"), (10, "é É"), (11, "é É"), (13, "é é")]
    assert got(spark, rows) == brute(rows)


def test_groups_and_blocks_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(M, "GROUP", 3)
    monkeypatch.setattr(M, "BLOCK", 2)
    rows = corpus(120, 5, words=60)
    assert got(spark, rows) == brute(rows)


def test_blocks_of_a_few_shingles_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(M, "WEIGHT", 200)
    rows = corpus(80, 5)
    assert got(spark, rows) == brute(rows)


def test_members_of_a_crowd_stand_once(spark, monkeypatch):
    """A crowd in one band that is not linked: what a block is handed grows with the members, not with their square."""
    rng, handed = np.random.default_rng(3), spark.sparkContext.accumulator(0)
    common = rng.integers(-(2**62), 2**62)
    rows = [(i, i, -i, 100, [int(common), *map(int, rng.integers(-(2**62), 2**62, M.BANDS - 1))], *map(int, rng.integers(-(2**62), 2**62, len(M.WORDS)))) for i in range(700)]
    nodes = spark.createDataFrame(rows, f"node long, {M.ROW_KEY[0]} long, {M.ROW_KEY[1]} long, n long, bands array<long>, " + ", ".join(f"{w} long" for w in M.WORDS))
    opened = M._open
    monkeypatch.setattr(M, "_open", lambda table: (handed.add(table.num_rows), opened(table))[1])
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert M.classes(nodes, docs).count() == 0 and handed.value == 700


def test_odd_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert M.near_duplicates(empty).collect() == [] and M.near_duplicates(empty).columns == ["doc_id", "n_shingles", "component_id", "kept"]
    same = [(4, "a b c d e f"), (4, "a b c d e f"), (9, "a b c d e f")]
    assert got(spark, same) == [(4, 3, 4, True), (4, 3, 4, True), (9, 3, 4, False)]
    lost = spark.createDataFrame([(None, "a b c d e"), (None, None)], "doc_id long, text string")
    assert [tuple(r) for r in M.near_duplicates(lost.orderBy(F.col("text").desc_nulls_last())).orderBy(F.desc("n_shingles")).collect()] == [(None, 2, None, True), (None, 0, None, True)]
    long = " ".join(f"t{i}" for i in range(30_000))
    assert got(spark, [(1, long), (2, long + " end"), (3, "t1 t2")]) == [(1, 29_997, 1, True), (2, 29_998, 1, False), (3, 1, 3, True)]


def test_sketches_keep_similar_sets_and_tell_others_apart():
    rng = np.random.default_rng(0)
    bits = lambda a, b: int(np.bitwise_count((x := M.sketches_of(np.stack([M.minima(a), M.minima(b)])).view(np.uint64))[0] ^ x[1]).sum())
    near, far = [], []
    for _ in range(60):
        common = rng.integers(0, 2**63, 800).astype(np.uint64)
        more = lambda n: np.concatenate([common, rng.integers(0, 2**63, n).astype(np.uint64)])
        near.append(bits(more(100), more(100)))  # similarity 0.8
        far.append(bits(more(2000), more(2000)))  # 1 in 6
    assert max(near) <= M.most_bits() < min(far)
    # the estimate that the method is named for: 1 + size / (4 * samples) * ln(1 - 2 * bits / size)
    estimate = 1 + M.SKETCH / (4 * M.BANDS * M.ROWS) * np.log(1 - 2 * np.mean(near) / M.SKETCH)
    assert abs(estimate - 0.8) < 0.02


def test_bands_meet_as_often_as_they_should():
    rng, met = np.random.default_rng(3), []
    for _ in range(120):
        common = rng.integers(0, 2**63, 400).astype(np.uint64)
        least = np.stack([M.minima(np.concatenate([common, rng.integers(0, 2**63, 50).astype(np.uint64)])) for _ in range(2)])
        own = M.bands_of(least)
        met.append((own[0] == own[1]).mean())
    assert abs(np.mean(met) - 0.8**M.ROWS) < 0.03 and min(met) > 0

import random
import re
from collections import Counter

import numpy as np
import pytest

from tabularium.llm import phrases as P

SCHEMA = "text string, lang string, rank int, n string"


def brute(rows, least=30, top=2000):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, n = {}, Counter()
    for text, lang in rows:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(lower)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            n[lang] += len(words)
            for size in range(1, 5):
                f.setdefault(lang, Counter()).update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, own in f.items():
        found = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in found.items():
            longer = [b for q, b in found.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if not any(100 * b >= 80 * a for b in longer):
                score, _, left, right = min((2000000 * a // (own[p[:k]] + own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, i, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


def corpus(n, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["É", "é", "Of", "of", "a\x00b", "x y"]
    fixed = ["new York city", "of the kind of the", "a b c d e", "É é of"]
    rows = []
    for _ in range(n):
        text = "".join(rng.choice([rng.choice(fixed), rng.choice(words), rng.choice(words)]) + rng.choice([" ", " ", "\t ", ". ", "\n", "\r\n", "; "]) for _ in range(rng.randint(0, 80)))
        rows.append((text, rng.choice(["en", "fr", None])))
    return rows + [(None, "en"), ("", None), (" .,", "xx")]


def got(spark, rows, **kw):
    df = spark.createDataFrame([(t, lang, 1, "x") for t, lang in rows], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in P.collocations(df, **kw).collect())


@pytest.mark.parametrize("seed,shard,filled", [(1, 10**6, 1 << 22), (2, 100, 1 << 10)])
def test_collocations_equal_brute_force(spark, monkeypatch, seed, shard, filled):
    monkeypatch.setattr(P, "SHARD", shard)
    monkeypatch.setattr(P, "MOST_WORDS", filled)
    rows = corpus(300, seed)
    want = brute(rows)
    assert len(want) > 20 and got(spark, rows) == want


def test_top_and_least(spark):
    rows = corpus(120, 4)
    assert got(spark, rows, least=5, top=7) == brute(rows, 5, 7)


def test_tables_without_words(spark):
    empty = P.collocations(spark.createDataFrame([], SCHEMA))
    assert empty.collect() == [] and empty.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert got(spark, [(None, None), (" . ", "en")]) == []


def test_one_phrase(spark):
    rows = [("a b", "en")] * 40
    assert got(spark, rows) == [("en", 1, "a b", 40, 40, 40, 80, 1_000_000)]


def test_counts_near_the_end_of_64_bits(spark, monkeypatch):
    # as many occurrences as no test can hold: the merged counts are given
    big = 2**62
    counts = spark.createDataFrame([("en", "a", 1, big), ("en", "b", 1, big - 1), ("en", "a b", 2, big - 2)], "lang string, phrase string, size int, f long")
    totals = spark.createDataFrame([("en", 2**63 - 1)], "lang string, n long")
    monkeypatch.setattr(P, "frequent_phrases", lambda docs, least: (counts, totals))
    assert [tuple(r) for r in P.collocations(None).collect()] == [("en", 1, "a b", big - 2, big, big - 1, 2**63 - 1, 2_000_000 * (big - 2) // (2 * big - 1))]


def test_suffix_array_and_intervals():
    rng = np.random.default_rng(5)
    words = rng.integers(0, 4, 500)  # zeros are breaks
    ids = np.concatenate([words, np.zeros(P.LONGEST, np.int64)])
    starts = np.nonzero(ids)[0]
    array = P.suffix_array(ids, starts)
    assert sorted(array) == starts.tolist() and [tuple(ids[i : i + 4]) for i in array] == sorted(tuple(ids[i : i + 4]) for i in starts)
    lcp = P.prefixes(ids, array)
    for n in range(1, 5):
        grams = Counter(tuple(ids[i : i + n]) for i in starts if (ids[i : i + n] != 0).all())
        first, counts = P.intervals(lcp, n)
        found = {tuple(ids[array[i] : array[i] + n]): c for i, c in zip(first, counts) if (ids[array[i] : array[i] + n] != 0).all()}
        assert found == grams


def test_a_full_filter_holds_more_never_less():
    rng = np.random.default_rng(7)
    inside, outside = (rng.integers(0, 2**63, 5000).astype(np.uint64) for _ in range(2))
    words = np.zeros(1 << 10, np.uint64)
    for k in range(4):
        np.bitwise_or.at(words, (inside >> np.uint64(40)) & np.uint64(1023), np.uint64(1) << ((inside >> np.uint64(6 * k)) & np.uint64(63)))
    assert P.Filter(words).holds(inside).all() and P.Filter(words).holds(outside).mean() < 0.2


def test_words_of_a_text_are_listed_at_once(monkeypatch):
    text = b"One two.\x0bTHREE\tfour,, \xc3\x89t\xc3\xa9 five;six " + b"seven!" * 9
    pieces = [p.split() for p in text.lower().translate(bytes.maketrans(P.PIECES, b"\n" * len(P.PIECES))).split(b"\n")]
    for stretch in (1 << 20, 20, 1):
        monkeypatch.setattr(P, "STRETCH", stretch)
        shard, lists = P.Shard(), [*P.stretches(text)]
        for words in lists:
            shard.add(words, "en")
        said = [shard.words[i] for i in shard.ids if i]
        assert said == [w for p in pieces for w in p]
        # breaks stand between the same words
        runs = b" ".join(shard.words[i] or b"\n" for i in shard.ids).split(b"\n")
        assert [r.split() for r in runs if r.split()] == [p for p in pieces if p]
        assert len(lists) == 1 or stretch < len(text)
    assert [*P.stretches(b"")] == []

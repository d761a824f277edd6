"""Phrase collocations from suffix arrays of word ids, built shard by shard and merged by key.

A task joins the texts of its partition into shards of up to SHARD words. Words become ids (of the shard, one for each
language and word), pieces are parted by breaks, and prefix doubling sorts the suffixes by their first LONGEST words: ranks
of single words, of pairs, of fours. Neighbours in that order have a common prefix; the intervals where it is at least n
words long are the n-grams of the shard, and their lengths the counts. Counts are merged over all shards.

A phrase is frequent only if both phrases within it that are a word shorter are, so lengths are counted one after another:
the words first; then the texts are written without their rare words, and pass n over what is left of them merges the
hashes of n-grams whose parts a Bloom filter of the frequent (n - 1)-grams holds, and sends as text the (n - 1)-grams that the
filter holds. The filters are of bounded size (``MOST_WORDS``); a full one lets more n-grams pass, and no result changes, for
what counts in the end are the texts and their merged counts.

Defined results: a null text is empty, a null lang is ``und``. A-Z are lower-cased, texts are split at PIECES and pieces at
spaces and tabs; texts without words add nothing. Texts of any length are read whole, in several shards if need be. Every
row counts, so a row that is there twice counts twice. Ties in the order cannot be, for a phrase stands once in a
language. Columns besides text and lang are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bloom_filter, clean_text, stash, worker_release

LEAST, LONGEST, TOP, SCALE = 30, 4, 2000, 2_000_000
#: A phrase is part of a longer one if that has this share of its occurrences, in percent.
SUBSUMED = 80
#: Characters that end a piece.
PIECES = b".,;:!?\n\x0b\x0c\r"
#: Words of a shard.
SHARD = 500_000
#: Texts that are pruned at once.
TEXTS = 64
#: 64-bit words of a filter of frequent n-grams, 32 MB at most; 16 bits an n-gram below that.
MOST_WORDS = 1 << 22
SEED = 42

#: What stands for a break: no word has it.
BREAK = b"."
_TO_BREAK = bytes.maketrans(PIECES, BREAK * len(PIECES))
#: Bytes of a text, at most about, whose words are listed at once.
STRETCH = 1 << 20
_ODD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _join(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of an n-gram from that of its first n - 1 words and that of its last word."""
    x = (h * _ODD) ^ (word + (h >> np.uint64(7)))
    x = (x ^ (x >> np.uint64(29))) * _MIX
    return x ^ (x >> np.uint64(32))


class Filter:
    """Blocked Bloom filter of 64-bit hashes: the frequent n-grams of one length."""

    def __init__(self, words: np.ndarray):
        self.words = words

    def holds(self, h: np.ndarray) -> np.ndarray:
        own = self.words[(h >> np.uint64(40)) & np.uint64(len(self.words) - 1)]
        found = np.ones(len(h), bool)
        for k in range(4):
            found &= (own >> ((h >> np.uint64(6 * k)) & np.uint64(63))) & np.uint64(1) == 1
        return found


class _Ids(dict):
    """Ids of the words of one language; a new word gets the shard's next one."""

    def __init__(self, shard: Shard, lang: str):
        super().__init__({BREAK: 0})
        self.shard, self.lang = shard, lang

    def __missing__(self, word: bytes) -> int:
        at = self[word] = len(self.shard.words)
        self.shard.words.append(word)
        self.shard.langs.append(self.lang)
        return at


class Shard:
    """Words of one shard as ids; id 0 is a break between pieces."""

    def __init__(self):
        self.ids: list[int] = [0]
        self.index: dict[str, _Ids] = {}
        self.words: list[bytes] = [b""]
        self.langs: list[str] = [""]

    def add(self, words: list[bytes], lang: str) -> None:
        """Words and breaks, as ``stretches`` gives them; a break follows."""
        if lang not in self.index:
            self.index[lang] = _Ids(self, lang)
        self.ids.extend(map(self.index[lang].__getitem__, words))
        self.ids.append(0)

    def hashes(self) -> np.ndarray:
        from xxhash import xxh64_intdigest

        seeds = {lang: xxh64_intdigest(lang.encode(), SEED) for lang in self.index}
        return np.array([0, *(xxh64_intdigest(w, seeds[lang]) for w, lang in zip(self.words[1:], self.langs[1:]))], np.uint64)


def suffix_array(ids: np.ndarray, starts: np.ndarray, depth: int = LONGEST) -> np.ndarray:
    """``starts`` in the order of their first ``depth`` words (a power of two), by prefix doubling; ids end in ``depth`` zeros.

    Ranks are made only of the places that the next doubling looks at.
    """
    rank, known = ids.astype(np.int64), 1
    while known < depth:
        wanted = np.zeros(len(ids), bool)
        for ahead in range(0, depth - known, 2 * known):
            wanted[starts + ahead] = True
        at = np.flatnonzero(wanted)
        pair = rank[at] * (rank.max(initial=0) + 1) + rank[at + known]
        rank = np.zeros_like(rank)
        rank[at] = np.unique(pair, return_inverse=True)[1] if 2 * known < depth else pair
        known *= 2
    return starts[np.argsort(rank[starts], kind="stable")]


def prefixes(ids: np.ndarray, array: np.ndarray, depth: int = LONGEST) -> np.ndarray:
    """Common words of each suffix and the one before it, ``depth`` at most; a break is common to none."""
    lcp, same = np.zeros(len(array), np.int64), np.ones(max(0, len(array) - 1), bool)
    for k in range(depth):
        a, b = ids[array[:-1] + k], ids[array[1:] + k]
        same = same & (a == b) & (a != 0)
        lcp[1:] += same
    return lcp


def intervals(lcp: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """First place in the suffix array, and length, of each interval with ``n`` common words."""
    first = np.nonzero(lcp < n)[0]
    return first, np.diff(np.append(first, len(lcp)))


def stretches(raw: bytes):
    """Lists of the words of a text, lower-cased, with BREAK between pieces; a long text is cut at a break after some STRETCH bytes."""
    raw, at = raw.lower().translate(_TO_BREAK), 0
    while at < len(raw):
        end = raw.find(BREAK, at + STRETCH) if len(raw) - at > STRETCH else -1
        part = raw[at:] if end < 0 else raw[at:end]
        # white space that is left in a piece is spaces and tabs
        yield part.replace(BREAK, b" . ").split()
        at += len(part) + 1


GRAMS = "lang string, phrase string, hash long, count long"


def shard_grams(shard: Shard, n: int, filters: list[Filter]) -> tuple[list, list]:
    """The hashed n-grams of a shard, (hash, count), and the texts of its frequent (n - 1)-grams, (lang, text, count).

    ``filters``: of lengths 1 to n - 1; that of the words has been used on the texts. Beyond LONGEST words only texts are given.
    """
    ids = np.concatenate([np.array(shard.ids, np.int64), np.zeros(LONGEST, np.int64)])
    h = shard.hashes()
    # gram[k]: hash of the (k + 1)-gram at each place; live[k]: it has all its words, and the filters hold it
    gram, live = [h[ids]], [ids != 0]
    for k in range(1, min(n, LONGEST)):
        ahead, after = np.zeros_like(gram[0]), np.zeros_like(live[0])
        ahead[:-k], after[:-1] = gram[0][k:], live[k - 1][1:]
        gram.append(_join(gram[k - 1], ahead))
        both = live[k - 1] & after
        live.append(both & filters[k].holds(gram[k]) if k < n - 1 else both)
    array = suffix_array(ids, np.flatnonzero(live[n - 2]), 2 if n == 2 else LONGEST)
    lcp = prefixes(ids, array, min(n, LONGEST))
    first, counts = intervals(lcp, n - 1)
    words, langs = shard.words, shard.langs
    texts = [(langs[own[0]], b" ".join([words[i] for i in own]).decode(), c) for own, c in zip(ids[array[first][:, None] + np.arange(n - 1)].tolist(), counts.tolist())]
    if n > LONGEST:
        return [np.zeros(0, np.uint64), np.zeros(0, np.int64)], texts
    first, counts = intervals(lcp, n)
    kept = live[n - 1][array[first]]
    return [gram[n - 1][array[first[kept]]], counts[kept]], texts


def _gram_batch(h: np.ndarray, counts: np.ndarray, texts: list):
    import pyarrow as pa

    none = [None] * len(h)
    hashes = pa.concat_arrays([pa.nulls(len(texts), pa.int64()), pa.array(h.view(np.int64))])
    numbers = np.concatenate([np.array([t[2] for t in texts], np.int64), counts.astype(np.int64)])
    return pa.RecordBatch.from_arrays([pa.array([t[0] for t in texts] + none, pa.string()), pa.array([t[1] for t in texts] + none, pa.string()), hashes, pa.array(numbers)], names=["lang", "phrase", "hash", "count"])


def _shards(batches, size: int):
    """The texts of a partition as shards of up to ``size`` words."""
    import pyarrow as pa

    shard = Shard()
    for batch in batches:
        for raw, lang in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("lang").to_pylist()):
            for words in stretches(raw):
                shard.add(words, lang)
                if len(shard.ids) > size:
                    yield shard
                    shard.index.clear()  # ids and shard know each other
                    shard = Shard()
    if len(shard.words) > 1:
        yield shard


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, phrase, hash, count): hashes of the words, and of each language the empty phrase with the count of all words."""
    size = SHARD

    def run(batches):
        worker_release()
        for shard in _shards(batches, size):
            h, counts, total = shard.hashes(), np.bincount(np.array(shard.ids, np.int64), minlength=len(shard.words)), dict.fromkeys(shard.index, 0)
            for lang, c in zip(shard.langs[1:], counts[1:].tolist()):
                total[lang] += c
            yield _gram_batch(h[1:], counts[1:], [(lang, "", c) for lang, c in total.items()])

    return docs.mapInArrow(run, GRAMS)


def pruned_texts(docs: DataFrame, frequent) -> DataFrame:
    """(text, lang) without the words that the filter of frequent ones does not hold: each is the end of a piece."""
    import pyarrow as pa

    def run(batches):
        worker_release()
        held = Filter(frequent.value)
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                shard, ends, langs = Shard(), [], part.column("lang").to_pylist()
                for raw, lang in zip(part.column("text").cast(pa.binary()).to_pylist(), langs):
                    for words in stretches(raw):
                        shard.add(words, lang)
                    ends.append(len(shard.ids))
                kept = held.holds(shard.hashes())
                kept[0] = False
                said = [w if k else BREAK for w, k in zip(shard.words, kept.tolist())]
                ids = np.array(shard.ids, np.int64)
                # of breaks beside each other one is enough
                need = np.append(True, kept[ids[1:]] | kept[ids[:-1]])
                texts, start = [], 0
                for end in ends:
                    texts.append(b" ".join(map(said.__getitem__, ids[start:end][need[start:end]].tolist())).decode())
                    start = end
                shard.index.clear()
                yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(langs, pa.string())], names=["text", "lang"])

    return docs.mapInArrow(run, "text string, lang string")


def gram_counts(docs: DataFrame, n: int, filters: list) -> DataFrame:
    """(lang, phrase, hash, count): hashes of n-grams, and texts of the (n - 1)-grams that the last filter holds."""
    size = SHARD

    def run(batches):
        worker_release()
        held = [Filter(f.value) for f in filters]
        for shard in _shards(batches, size):
            (h, counts), texts = shard_grams(shard, n, held)
            yield _gram_batch(h, counts, texts)

    return docs.mapInArrow(run, GRAMS)


def _filter(frequent: DataFrame):
    """The hashes of ``frequent`` as a broadcast Bloom filter; at most MOST_WORDS words reach the driver."""
    spark = frequent.sparkSession
    rows = frequent.count()
    words = min(MOST_WORDS, max(1 << 10, 1 << max(0, (rows // 4 - 1).bit_length())))
    found = bloom_filter(frequent, "hash", words).toArrow()
    bits = np.zeros(words, np.uint64)
    bits[found.column("__tb_word").to_numpy()] = found.column("__tb_bits").to_numpy().view(np.uint64)
    return spark.sparkContext.broadcast(bits)


def frequent_phrases(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, f) of every phrase of up to LONGEST words with f >= ``least``; and (lang, n), the words of a language."""
    slim = docs.select(clean_text().alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    merge = lambda grams, n: stash(grams.groupBy("lang", "phrase", "hash").agg(F.sum("count").alias("f")).where((F.col("f") >= least) | (F.col("phrase") == "")), f"grams{n}")
    counted = merge(word_counts(slim), 1)
    totals = counted.where("phrase = ''").select("lang", F.col("f").alias("n"))
    filters, found = [_filter(counted.where("phrase is null").select("hash"))], None
    left = stash(pruned_texts(slim, filters[0]), "left")
    for n in range(2, LONGEST + 2):
        counted = merge(gram_counts(left, n, filters), n)
        own = counted.where("phrase is not null").select("lang", "phrase", F.lit(n - 1).alias("size"), "f")
        found = own if found is None else found.unionByName(own)
        if n <= LONGEST:
            filters.append(_filter(counted.where("phrase is null").select("hash")))
    return found, totals


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best ``top`` phrases of each language."""
    found, totals = frequent_phrases(docs, least)
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    phrases = found.where("size > 1").select("lang", "phrase", "size", F.col("f").alias("a")).withColumn("words", F.split("phrase", " "))
    cuts = phrases.withColumn("k", F.explode(F.expr("sequence(1, size - 1)")))
    cuts = cuts.withColumn("head", F.array_join(F.expr("slice(words, 1, k)"), " ")).withColumn("tail", F.array_join(F.expr("slice(words, k + 1, size)"), " "))
    part = lambda name, f: found.select("lang", F.col("phrase").alias(name), F.col("f").alias(f))
    cut = cuts.join(part("head", "l"), ["lang", "head"]).join(part("tail", "r"), ["lang", "tail"])
    cut = cut.withColumn("up", wide("a") * F.lit(SCALE).cast("decimal(7,0)")).withColumn("down", wide("l") + wide("r")).withColumn("score", F.expr("up div down"))
    scored = cut.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"), F.max("a").alias("a"))
    # every phrase within a longer one, with the most frequent that holds it
    within = phrases.where("size > 2").select("lang", "words", "size", "a", F.explode(F.expr("sequence(2, size - 1)")).alias("m"))
    within = within.select("lang", "words", "m", "a", F.explode(F.expr("sequence(1, size - m + 1)")).alias("i"))
    longer = within.groupBy("lang", F.array_join(F.expr("slice(words, i, m)"), " ").alias("phrase")).agg(F.max("a").alias("longest"))
    kept = scored.join(longer, ["lang", "phrase"], "left").where(F.col("longest").isNull() | (wide("longest") * 100 < wide("a") * SUBSUMED))
    order = Window.partitionBy("lang").orderBy(F.col("best.score").desc(), F.col("a").desc(), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)  # cut to ``top`` in each task before the shuffle
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("best.l").alias("l"), F.col("best.r").alias("r"), "n", F.col("best.score").alias("score"))


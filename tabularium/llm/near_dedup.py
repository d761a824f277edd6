"""SimHash near-dedup with pigeonring filtering.

A fingerprint has 64 bits in SEGMENTS segments on a ring. If two differ in at most DISTANCE bits, then from some segment
on, every chain of l consecutive segments differs in at most l * DISTANCE / SEGMENTS bits: for 4 segments and 3 bits, a
segment that is equal, two that differ in one bit at most, three in two, four in three. The candidate join asks for the
chain of two at once: its key is an equal segment and the next one up to one flipped bit (one side spells out the 17
forms), 32 bits in all, so that few unrelated fingerprints meet. The longer chains prune what the join finds, and the
last is the full Hamming check.

Only distinct fingerprints enter the join, so copies are never expanded into pairs. Links become components on the
cluster; a document's component is the smallest doc_id that it can reach.

Defined results: a null text counts as empty. A text with one or two words has one shingle, its whole sequence; one
without words has fingerprint zero, and links like any other. Texts of any length are read whole, BLOCK shingles at a
time. A bit that exactly half the shingles set is zero. Repeated rows share a fingerprint. A null doc_id is ignored as a
component's name unless there is no other. Columns besides doc_id and text are ignored, whatever their names. An empty
table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bloom_filter, bloom_probe, bloom_words, clean_text, lookup, parts, stash, worker_release
from .components import components

SHINGLE = 3
SEGMENTS = 4
BITS = 64 // SEGMENTS
DISTANCE = 3
SEED = 42
#: Shingles whose bits are counted at once.
BLOCK = 50_000


def fingerprint(text: str) -> int:
    """Signed 64-bit SimHash of the word shingles of a whole text."""
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()  # of bytes: A-Z only, and exactly the six ASCII white-space bytes
    if not words:
        return 0
    n = max(1, len(words) - SHINGLE + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, BLOCK):
        own = words[at : at + BLOCK + SHINGLE - 1]
        line, k = b" ".join(own), min(BLOCK, n - at)
        if len(own) > SHINGLE:
            ends = np.cumsum([*map(len, own)]) + np.arange(len(own))
            starts = [0, *(ends[: k - 1] + 1).tolist()]
            hashes = [xxh64_intdigest(line[a:b], SEED) for a, b in zip(starts, ends[SHINGLE - 1 :].tolist())]
        else:
            hashes = [xxh64_intdigest(line, SEED)]
        bits = np.unpackbits(np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, *keys: str) -> DataFrame:
    """doc_id, ``keys``, fp (signed long) of every row of (doc_id, text, ``keys``)."""
    import pyarrow as pa
    from pyspark.sql.types import LongType, StructField, StructType

    names = ["doc_id", *keys]

    def run(batches):
        worker_release()
        for b in parts(batches):
            yield pa.RecordBatch.from_arrays([*map(b.column, names), pa.array([*map(fingerprint, b.column("text").to_pylist())], pa.int64())], names=[*names, "fp"])

    slim = docs.select(*names, clean_text().alias("text"))
    return slim.mapInArrow(run, StructType([*(slim.schema[c] for c in names), StructField("fp", LongType())]))


def _ring(fp: Column, start: int, length: int) -> Column:
    """``length`` segments from ``start`` on, round the ring, as a number."""
    turned = fp if not start else F.shiftrightunsigned(fp, BITS * start).bitwiseOR(F.shiftleft(fp, 64 - BITS * start))
    return turned if length == SEGMENTS else turned.bitwiseAND(F.lit((1 << BITS * length) - 1).cast("long"))


def _key(chain: Column, start: int) -> Column:
    return F.lit(start << 2 * BITS).cast("long").bitwiseOR(chain)


def links(fps: DataFrame) -> DataFrame:
    """Pairs a < b of distinct fingerprints (column fp) that differ in at most DISTANCE bits; a pair may come twice."""
    flips = [0, *(1 << (BITS + b) for b in range(BITS))]  # in the second segment of the chain
    fp = F.col("fp")
    index = fps.select(fp.alias("b"), F.explode(F.array(*(_key(_ring(fp, s, 2), s) for s in range(SEGMENTS)))).alias("key"))
    forms = [_key(_ring(fp, s, 2).bitwiseXOR(F.lit(x).cast("long")), s) for s in range(SEGMENTS) for x in flips]
    probes = fps.select(fp.alias("a"), F.explode(F.array(*forms)).alias("key"))
    met = probes.join(index, "key").where("a < b")
    apart, start = F.col("a").bitwiseXOR(F.col("b")), F.shiftright(F.col("key"), 2 * BITS)
    budget = F.lit(True)
    for length in range(3, SEGMENTS + 1):
        differ = F.lit(None).cast("int")
        for s in range(SEGMENTS):
            differ = F.when(start == s, F.bit_count(_ring(apart, s, length))).otherwise(differ)
        budget = budget & (differ <= length * DISTANCE // SEGMENTS)
    return met.where(budget).select("a", "b")


def _placed(prints: DataFrame) -> DataFrame:
    """Each fingerprint of ``prints`` (doc_id, fp): fp, copies (its rows), first (its least doc_id), root (null: no link)."""
    groups = stash(prints.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies")), "groups")
    roots = components(links(groups.select("fp")))
    return groups.join(roots, groups.fp == roots.node, "left").select("fp", "copies", "first", "root")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row of (doc_id, text)."""
    prints = stash(fingerprints(docs), "prints")
    rows = prints.count()
    placed = _placed(prints)
    named = placed.where("root is not null").groupBy("root").agg(F.min("first").alias("least"), F.count("*").alias("members"))
    linked = lookup(placed.where("root is not null"), named, "root", "members", rows).select("fp", "copies", F.col("least").alias("component_id"))
    alone = placed.where("root is null").select("fp", "copies", F.col("first").alias("component_id"))
    found = lookup(prints, linked.unionByName(alone), "fp", "copies", rows)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest doc_id (a null one comes last); all columns stay.

    Rows are told apart by doc_id and a hash of the text, so a repeated doc_id loses only the rows that are near copies;
    rows that repeat both are one row. Of several texts with the smallest doc_id one stays. Rows that surely need not go
    are passed straight through; only the others are joined.
    """
    prints = stash(fingerprints(docs.select("doc_id", "text", _text_key()), "__tb_text"), "prints")
    total = prints.count()
    # fingerprints of one row without a link are alone: nothing of theirs can go
    crowded = stash(_placed(prints).where("root is not null or copies > 1").select("fp", "copies", F.coalesce("root", "fp").alias("component")), "crowded")
    rows = stash(lookup(prints, crowded, "fp", "copies", total).where("component is not null").select("doc_id", "__tb_text", "component"), "crowd")
    keep = rows.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "__tb_text")).alias("keep"))
    keep = keep.select(F.col("keep.doc_id").alias("__tb_id"), F.col("keep.__tb_text").alias("__tb_key"), F.lit(True).alias("__tb_keep"))
    keys = rows.groupBy("doc_id", "__tb_text").agg(F.count("*").alias("n"))
    judged = keys.join(keep, F.col("doc_id").eqNullSafe(F.col("__tb_id")) & (F.col("__tb_text") == F.col("__tb_key")), "left")
    dropped = judged.where("__tb_keep is null or n > 1").select(F.col("doc_id").alias("__tb_id"), F.col("__tb_text").alias("__tb_key"), F.coalesce("__tb_keep", F.lit(False)).alias("__tb_keep"))
    return without(docs, stash(dropped, "dropped"))


def _text_key() -> Column:
    return F.xxhash64(clean_text()).alias("__tb_text")


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose doc_id and text are not among ``dropped`` (__tb_id, __tb_key); one row where __tb_keep is set."""
    words = bloom_words(dropped.count())
    bloom = stash(bloom_filter(dropped.select(F.xxhash64("__tb_id", "__tb_key").alias("__tb_x")), "__tb_x", words), "bloom")
    probed = bloom_probe(docs.withColumn("__tb_text", _text_key()), bloom, F.xxhash64("doc_id", "__tb_text"), words, "__tb_maybe")
    found = probed.where("__tb_maybe").join(dropped, F.col("doc_id").eqNullSafe(F.col("__tb_id")) & (F.col("__tb_text") == F.col("__tb_key")), "left")
    rest = found.where("__tb_keep is null")
    once = found.where("__tb_keep").dropDuplicates(["doc_id", "__tb_text"])
    return probed.where(~F.col("__tb_maybe")).select(*docs.columns).unionByName(rest.select(*docs.columns)).unionByName(once.select(*docs.columns))

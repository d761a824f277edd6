"""MinHash near-dedup: banded candidates, odd sketches to screen them, whole shingle sets to confirm them.

A document is the set of its distinct shingles of SHINGLE words. BANDS bands of ROWS minima each make candidates: sets of
similarity 0.8 agree in no band with a chance below 1e-6, and that is the only way in which a link can be missed. The same
BANDS * ROWS minima are folded into a bitmap of SKETCH bits, each minimum toggling one bit. Where two sets differ in d
minima their bitmaps differ in 2 * d bits at most, and in fewer by chance; ``most_bits`` is the bound that sets of
similarity 0.8 keep but once in MISS. Pairs within the bound (a bit count of XORed words, on the JVM) are confirmed on
their whole sets.

Only distinct sets become nodes, so copies are never expanded into pairs. Nor are the members of a band: the classes met in
it are dealt into groups of about GROUP, each compared with one of its members, and what is linked becomes one class. That
is repeated as long as it unites a good part of what is left. Then every pair of members of different classes is compared
by sketch, in the first band that the two have in common; members with a partner within the bound get their sets, and a
block gives the links of a spanning forest. So no link between classes is lost. A block is as large as a task holds, BLOCK
members for the sketches and about WEIGHT shingles for the sets, so a band is one block, and its members stand once, unless it
is beyond that; then each of its blocks meets each other one. What leaves a task grows with its members, not with their
pairs. Sets are made of the texts again where they are needed.

Defined results: a null text counts as empty; a document without words has an empty set and is linked with nothing. A text
with fewer words than a shingle has one, its whole sequence. Shingles are told apart by 64 bits of XXH64, sets by 128 of
XXH3. Texts are read whole; a very long one is hashed in steps. Rows that repeat a doc_id are rows of their own; those with
equal sets are linked. A null doc_id names a component only if there is no other. Columns besides doc_id and text are
ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from functools import cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bloom_filter, bloom_probe, bloom_words, clean_text, lookup, stash, worker_release
from .components import components

SHINGLE = 4
BANDS, ROWS = 35, 5
SKETCH = 1024
#: Intersection and union count as similar from PERCENT on.
PERCENT = 80
MISS = 1e-7
SEED = 42
#: Members of a band that are compared with one of them; members of a block in the last, full comparison (2 MB of sketches and
#: bands), and shingles of a block whose sets are compared (32 MB).
GROUP, BLOCK, WEIGHT = 256, 4096, 1 << 22
#: Rounds go on while they link this share of the classes that they compare.
WORTH = 0.1
#: Shingles whose minima are taken at once.
STEP = 512

_ODD, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, elementwise."""
    x = (x ^ (x >> np.uint64(30))) * _MIX
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _family() -> tuple[np.ndarray, np.ndarray]:
    """Odd factors and offsets of the BANDS * ROWS hash functions."""
    n = np.arange(1, 2 * BANDS * ROWS + 1, dtype=np.uint64)
    made = _mixed(n * _ODD)
    return made[: BANDS * ROWS] | np.uint64(1), made[BANDS * ROWS :]


def shingles(text: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a whole text's shingles; empty without words."""
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "surrogatepass").lower().split()  # of bytes: A-Z only, and exactly the six ASCII white-space bytes
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    if len(words) <= SHINGLE:
        return np.array([xxh64_intdigest(line, SEED)], np.uint64)
    ends = np.cumsum([*map(len, words)]) + np.arange(len(words))
    starts = [0, *(ends[: len(words) - SHINGLE] + 1).tolist()]
    return np.unique(np.array([xxh64_intdigest(line[a:b], SEED) for a, b in zip(starts, ends[SHINGLE - 1 :].tolist())], np.uint64))


def minima(own: np.ndarray) -> np.ndarray:
    """The least value of each hash function over a set that is not empty."""
    factor, offset = _family()
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(own), STEP):
        np.minimum(least, (own[at : at + STEP, None] * factor + offset).min(0), out=least)
    return least


def bands_of(least: np.ndarray) -> np.ndarray:
    """(sets, BANDS) keys: the band and its ROWS minima."""
    grouped = least.reshape(len(least), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * _ODD, grouped.shape[:2]).copy()
    for r in range(ROWS):
        key = _mixed(key ^ grouped[:, :, r])
    return key.view(np.int64)


def sketches_of(least: np.ndarray) -> np.ndarray:
    """(sets, SKETCH / 64) words of the odd sketch."""
    each = np.arange(1, BANDS * ROWS + 1, dtype=np.uint64) * _ODD
    place = (_mixed(least ^ each) % np.uint64(SKETCH)).astype(np.int64)
    flat = (place + np.arange(len(least))[:, None] * SKETCH).ravel()
    odd = (np.bincount(flat, minlength=len(least) * SKETCH) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(np.int64).reshape(len(least), SKETCH // 64)


@cache
def most_bits(samples: int = BANDS * ROWS, size: int = SKETCH, percent: int = PERCENT, miss: float = MISS) -> int:
    """Differing bits that the sketches of two sets of that similarity exceed with a chance of ``miss`` at most.

    The number of differing minima is binomial; each toggles two bits, and a bit toggled twice is even again.
    """
    differ = np.zeros(samples + 1)
    differ[0] = 1.0
    for _ in range(samples):
        differ[1:], differ[0] = differ[1:] * percent / 100 + differ[:-1] * (1 - percent / 100), differ[0] * percent / 100
    odd, total = np.zeros(size + 1), np.zeros(size + 1)
    odd[0] = 1.0
    state = np.arange(size + 1)
    for d in range(samples + 1):
        total += differ[d] * odd
        for _ in range(2):
            up, down = odd * (size - state) / size, odd * state / size
            odd = np.zeros(size + 1)
            odd[1:] += up[:-1]
            odd[:-1] += down[1:]
    beyond = total[::-1].cumsum()[::-1]  # chance of so many bits or more
    return int(np.nonzero(beyond > miss)[0][-1])


WORDS = [f"__tb_s{i}" for i in range(SKETCH // 64)]


#: Tell apart the rows of a table, but for those that are equal.
ROW_KEY = ["__tb_k0", "__tb_k1"]


def _keyed(docs: DataFrame) -> DataFrame:
    slim = docs.select("doc_id", clean_text().alias("text"))
    return slim.select("*", *(F.xxhash64(F.lit(i), "doc_id", "text").alias(k) for i, k in enumerate(ROW_KEY)))


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, ROW_KEY, n (shingles), key (of the set), bands and the words of the sketch of every row of (doc_id, text)."""
    import pyarrow as pa
    from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType
    from xxhash import xxh3_128_digest

    names = ["doc_id", *ROW_KEY]

    def run(batches):
        worker_release()
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                sizes, keys, least = [], [], []
                for text in part.column("text").to_pylist():
                    own = shingles(text)
                    sizes.append(len(own))
                    keys.append(xxh3_128_digest(own.tobytes()))
                    if len(own):
                        least.append(minima(own))
                bands, sketch = np.zeros((len(sizes), BANDS), np.int64), np.zeros((len(sizes), len(WORDS)), np.int64)
                if least:
                    full = np.array(sizes) > 0
                    bands[full], sketch[full] = bands_of(np.stack(least)), sketches_of(np.stack(least))
                each = pa.ListArray.from_arrays(pa.array(np.arange(len(sizes) + 1) * BANDS, pa.int32()), pa.array(bands.ravel()))
                yield pa.RecordBatch.from_arrays([*map(part.column, names), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), each, *(pa.array(sketch[:, i].copy()) for i in range(len(WORDS)))], names=[*names, "n", "key", "bands", *WORDS])

    slim = _keyed(docs)
    fields = [StructField("n", LongType()), StructField("key", BinaryType()), StructField("bands", ArrayType(LongType())), *(StructField(w, LongType()) for w in WORDS)]
    return slim.mapInArrow(run, StructType([*(slim.schema[c] for c in names), *fields]))


def shingle_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, shingles) of the rows of ``docs`` that ``wanted`` (node, ROW_KEY) names; other texts don't leave the scan."""
    import pyarrow as pa

    def run(batches):
        worker_release()
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                own = [shingles(t).view(np.int64) for t in part.column("text").to_pylist()]
                ends = np.concatenate([[0], np.cumsum([len(s) for s in own])])
                yield pa.RecordBatch.from_arrays([part.column("node"), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(own) if own else np.zeros(0, np.int64)))], names=["node", "shingles"])

    words = bloom_words(wanted.count())
    bloom = stash(bloom_filter(wanted.select(F.xxhash64(*ROW_KEY).alias("h")), "h", words), "bloom")
    probed = bloom_probe(_keyed(docs), bloom, F.xxhash64(*ROW_KEY), words, "__tb_maybe").where("__tb_maybe")
    # rows that repeat a doc_id and a text are one
    found = probed.select(*ROW_KEY, "text").join(wanted, ROW_KEY).select("node", "text").dropDuplicates(["node"])
    return found.mapInArrow(run, "node long, shingles array<long>")


def within(a: str, b: str) -> Column:
    """Whether the sketches of columns ``a`` and ``b`` (structs of WORDS) differ in few enough bits."""
    apart = F.lit(0)
    for w in WORDS:
        apart = apart + F.bit_count(F.col(f"{a}.{w}").bitwiseXOR(F.col(f"{b}.{w}")))
    return apart <= most_bits()


def _sizes_allow(a: Column, b: Column) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * PERCENT


def _similar(a: np.ndarray, b: np.ndarray) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common * 100 >= (len(a) + len(b) - common) * PERCENT


class _Block:
    """The members of one block of a band, or of two: which of their pairs are still to be compared."""

    def __init__(self, table):
        self.node, self.kind, self.size, self.deal = (table.column(c).to_numpy() for c in ("node", "class", "n", "deal"))
        self.sketch = np.stack([table.column(w).to_numpy() for w in WORDS], 1).view(np.uint64)
        self.bands = table.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
        self.band, self.two = table.column("band")[0].as_py(), table.column("i")[0].as_py() != table.column("j")[0].as_py()
        self.order = np.argsort(self.node, kind="stable")

    def pairs(self):
        """Pairs of positions of different classes, within the bound, whose first common band this is."""
        most, at = most_bits(), self.order
        for x, u in enumerate(at):
            v = at[x + 1 :]
            keep = (self.kind[v] != self.kind[u]) & (np.minimum(self.size[v], self.size[u]) * 100 >= np.maximum(self.size[v], self.size[u]) * PERCENT)
            if self.two:
                keep &= self.deal[v] != self.deal[u]
            v = v[keep]
            v = v[np.bitwise_count(self.sketch[v] ^ self.sketch[u]).sum(1) <= most]
            same = self.bands[v] == self.bands[u]
            yield from ((u, w) for w in v[self.bands[u][same.argmax(1)] == self.band].tolist())


def _open(table):
    """(band, node, class) of a block's rows that have a partner to be compared with."""
    import pyarrow as pa

    met = {int(x) for pair in _Block(table).pairs() for x in pair}
    return table.select(["band", "node", "class"]).take(pa.array(sorted(met), pa.int64()))


def _forest(table):
    """Links (a, b) of a block's rows: each unites two of its classes."""
    import pyarrow as pa

    block, sets = _Block(table), table.column("shingles")
    own, root = {}, {c: c for c in block.kind.tolist()}

    def top(c):
        while root[c] != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    def of(i):
        if i not in own:
            own[i] = sets[i].values.to_numpy()
        return own[i]

    links = []
    for u, v in block.pairs():
        a, b = top(int(block.kind[u])), top(int(block.kind[v]))
        if a != b and _similar(of(u), of(v)):
            root[a] = b
            links.append((int(block.node[u]), int(block.node[v])))
    return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})


def _dealt(members: DataFrame, tops: DataFrame, deals: Column, total: int, by: str, turn: int) -> DataFrame:
    """``members`` of the bands in ``tops`` (band, met), with ``deals``, the groups of their band, and ``deal``, their own one."""
    found = lookup(members, tops.select("band", "met", F.ceil(deals).cast("int").alias("deals")), "band", "met", total).where("met is not null")
    return found.withColumn("deal", F.pmod(F.xxhash64(F.lit(turn), by), "deals").cast("int")).drop("met")


def _blocks(dealt: DataFrame) -> DataFrame:
    """Blocks (band, i, j) of dealt members: each group of a band meets each group once. Members of a band of one group stand once."""
    told = dealt.withColumn("k", F.explode(F.expr("sequence(0, deals - 1)")))
    return told.select(*dealt.columns, F.least("deal", "k").alias("i"), F.greatest("deal", "k").alias("j")).drop("deals")


def _several(members: DataFrame) -> DataFrame:
    """(band, met) of the bands that hold two classes or more."""
    return members.select("band", "class").distinct().groupBy("band").agg(F.count("*").alias("met")).where("met > 1")


def classes(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, root) of every node with a link; ``nodes``: node, ROW_KEY, n, bands, WORDS."""
    links, labels, turn = None, None, 0
    members = stash(nodes.select("node", F.explode("bands").alias("band")), "members")
    total = members.count()
    tops = stash(members.groupBy("band").agg(F.count("*").alias("met")).where("met > 1"), "bands")
    members = stash(lookup(members, tops, "band", "met", total).where("met is not null").select("band", "node", F.col("node").alias("class")), "members")

    def sets_of(rows: DataFrame) -> DataFrame:
        """Sets of the distinct nodes in a column ``node``."""
        ids = rows.select("node").distinct()
        return stash(shingle_sets(docs, nodes.select("node", *ROW_KEY).join(ids, "node")), "sets")

    while True:
        turn += 1
        one = stash(members.groupBy("band", "class").agg(F.min("node").alias("node")), "one")
        tops = stash(_several(one), "bands")
        dealt = stash(_dealt(one, tops, F.col("met") / GROUP, max(1, one.count()), "class", turn), "dealt")
        pivots = dealt.groupBy("band", "deal").agg(F.min(F.struct(F.xxhash64(F.lit(turn), "node").alias("h"), "node"))["node"].alias("pivot"))
        met = dealt.join(pivots, ["band", "deal"]).where("node <> pivot")
        pairs = met.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()
        about = nodes.select("node", F.struct("n", *WORDS).alias("s"))
        for side in "ab":
            pairs = pairs.join(about.select(F.col("node").alias(side), F.col("s").alias(f"s{side}")), side)
        screened = stash(pairs.where(_sizes_allow(F.col("sa.n"), F.col("sb.n")) & within("sa", "sb")).select("a", "b"), "screened")
        sets = sets_of(screened.select(F.explode(F.array("a", "b")).alias("node")))
        for side in "ab":
            screened = screened.join(sets.select(F.col("node").alias(side), F.col("shingles").alias(f"s{side}")), side)
        common = F.size(F.array_intersect("sa", "sb"))
        new = stash(screened.where(common * 100 >= (F.size("sa") + F.size("sb") - common) * PERCENT).select("a", "b"), "links")
        found = new.count()
        if found:
            links = new if links is None else links.unionByName(new)
            labels = stash(components(links), "labels")
            now = members.drop("class").join(labels.withColumnRenamed("root", "class"), "node", "left").withColumn("class", F.coalesce("class", "node"))
            now = stash(now.select("band", "node", "class"), "classed")
            tops = stash(_several(now), "bands")
            members = stash(lookup(now, tops, "band", "met", max(1, now.count())).where("met is not null").select("band", "node", "class"), "members")
        if not found or found < WORTH * dealt.select("class").distinct().count():
            break
    if not found:
        members = stash(members.join(stash(_several(members).select("band"), "bands"), "band"), "members")
    if labels is None:
        labels = components(nodes.limit(0).select(F.col("node").alias("a"), F.col("node").alias("b")))
    if members.isEmpty():
        return labels
    # what is left: every pair of different classes of a band
    tops = stash(members.groupBy("band").agg(F.count("*").alias("met")), "bands")
    about = nodes.select("node", "n", "bands", *WORDS)
    blocks = _blocks(_dealt(members, tops, F.col("met") / BLOCK, members.count(), "node", turn).join(about, "node"))
    left = stash(blocks.groupBy("band", "i", "j").applyInArrow(_open, "band long, node long, class long").distinct(), "open")
    found = left.join(about, "node")
    tops = stash(found.groupBy("band").agg(F.count("*").alias("met"), F.sum("n").alias("n")), "bands")
    rest = _blocks(_dealt(found, tops, F.col("n") / WEIGHT, max(1, left.count()), "node", turn)).join(sets_of(left), "node")
    new = stash(rest.groupBy("band", "i", "j").applyInArrow(_forest, "a long, b long"), "links")
    if new.isEmpty():
        return labels
    return components(new if links is None else links.unionByName(new))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of (doc_id, text)."""
    rows = stash(signatures(docs).withColumn("row", F.monotonically_increasing_id()), "signatures")
    total, full = rows.count(), rows.where("n > 0")
    groups = stash(full.groupBy("key").agg(F.min("row").alias("node"), F.min("doc_id").alias("least"), F.count("*").alias("copies")), "groups")
    slim = full.select("doc_id", "n", "key", "row")
    placed = lookup(slim, groups, "key", "copies", total).select("doc_id", "n", "node")
    nodes = stash(full.drop("key", "doc_id").join(groups.select(F.col("node").alias("row"), "least", "copies"), "row").withColumnRenamed("row", "node"), "nodes")
    roots = stash(classes(nodes, docs), "roots")
    about = nodes.select("node", "least", "copies").join(roots, "node", "left")
    linked = about.where("root is not null")
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("members"))
    linked = lookup(linked, least, "root", "members", total).select("node", "copies", "component_id")
    alone = about.where("root is null").select("node", "copies", F.col("least").alias("component_id"))
    found = lookup(placed, stash(linked.unionByName(alone), "named"), "node", "copies", total)
    empty = rows.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    every = found.select("doc_id", "n", "component_id").unionByName(empty)
    return every.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))

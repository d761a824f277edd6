"""Helpers that the operators of this subpackage share.

Internal columns start with ``__tb_`` so that they never clash with columns of a caller's table.
"""

from __future__ import annotations

import ctypes
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: A group counts as hot when it holds more than this share of the rows, so at most ``1 / HOT_SHARE`` groups are hot.
HOT_SHARE = 1 / 1000

#: Bits of a Bloom filter are held in rows (word, 64 bits). At most this many words are ever broadcast (about 40 MB hashed).
MAX_WORDS = 1 << 20

#: Rows of a batch that a Python worker holds as Python objects at once.
PART_ROWS = 1000


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``. Where none is set, one of this machine, if no other runs tasks."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        where = tempfile.mkdtemp(prefix="tabularium-")
        spark.sparkContext.setCheckpointDir(where)
    return where.rstrip("/")


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared scratch folder and read again: cuts the lineage, survives lost executors."""
    path = f"{scratch_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unstash(df: DataFrame) -> None:
    """Delete what ``stash`` wrote, once everything that reads it is itself written."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_kept: dict = {}


def worker_keep(owner, make):
    """What an operator keeps in a Python worker from task to task; only one owner's things are kept at a time."""
    if owner not in _kept:
        worker_release()
        _kept[owner] = make()
    return _kept[owner]


def worker_release() -> None:
    """Let go of what another operator left in this Python worker, and let the system have the memory."""
    if _kept:
        _kept.clear()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # of glibc, which else keeps what lies between live blocks
            trim(0)


def parts(batches):
    """The rows of Arrow batches in slices of PART_ROWS, so that a task never holds a whole batch as Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, PART_ROWS):
            yield batch.slice(at, PART_ROWS)


def clean_text(name: str = "text") -> Column:
    """Null counts as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only. ``lower`` is the same, and faster, where a text has ASCII only."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def bloom_words(rows: int) -> int:
    """Words for so many rows at 16 bits each, as a power of two within [2**10, MAX_WORDS]."""
    return min(MAX_WORDS, max(1 << 10, 1 << max(0, (rows // 4 - 1).bit_length())))


def bloom_word(h: Column, words: int) -> Column:
    return F.shiftrightunsigned(h, 40).bitwiseAND(F.lit(words - 1).cast("long"))


def bloom_mask(h: Column) -> Column:
    """Four of the 64 bits of a word, chosen by the low 24 bits of a hash."""
    one = F.lit(1).cast("long")
    bit = lambda k: F.call_function("shiftleft", one, F.shiftrightunsigned(h, 6 * k).bitwiseAND(F.lit(63).cast("long")).cast("int"))
    return bit(0).bitwiseOR(bit(1)).bitwiseOR(bit(2)).bitwiseOR(bit(3))


def bloom_filter(hashes: DataFrame, h: str, words: int) -> DataFrame:
    """Blocked Bloom filter as rows (__tb_word, __tb_bits); never more than ``words`` rows."""
    return hashes.groupBy(bloom_word(F.col(h), words).alias("__tb_word")).agg(F.bit_or(bloom_mask(F.col(h))).alias("__tb_bits"))


def bloom_probe(df: DataFrame, bloom: DataFrame, h: Column, words: int, flag: str) -> DataFrame:
    """Add ``flag``: false means surely not in the filter. The filter is broadcast; its size is bounded by ``words``."""
    probed = df.withColumns({"__tb_h": h}).withColumn("__tb_word", bloom_word(F.col("__tb_h"), words))
    mask = bloom_mask(F.col("__tb_h"))
    return (
        probed.join(F.broadcast(bloom), "__tb_word", "left")
        .withColumn(flag, F.coalesce(F.col("__tb_bits").bitwiseAND(mask) == mask, F.lit(False)))
        .drop("__tb_word", "__tb_bits", "__tb_h")
    )


class CountFilter:
    """Keys that several rows have, as a counting Bloom filter of one hash and a bounded number of cells.

    Pass 1 counts the rows of each cell (combined map-side, so a task sends one small row a cell at most) and keeps the
    cells with ``least`` rows or more, packed into words of 64. ``probe`` is pass 2: where ``flag`` is false, fewer than
    ``least`` rows have the key. More rows than cells make more rows pass, never fewer.
    """

    def __init__(self, keys: DataFrame, key: str, least: int):
        self.rows = keys.count()
        self.words = bloom_words(self.rows)
        met = keys.groupBy(self._cell(F.col(key)).alias("cell")).count().where(F.col("count") >= least)
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("cell").bitwiseAND(F.lit(63)))
        self.filter = stash(met.groupBy(F.shiftright("cell", 6).alias("__tb_word")).agg(F.bit_or(bit).alias("__tb_bits")), "met")

    def _cell(self, key: Column) -> Column:
        return F.xxhash64(key).bitwiseAND(F.lit(64 * self.words - 1).cast("long")).cast("int")

    def probe(self, df: DataFrame, key: str, flag: str = "__tb_maybe") -> DataFrame:
        """Add ``flag``. The filter has at most ``words`` rows and is broadcast."""
        celled = df.withColumn("__tb_cell", self._cell(F.col(key))).withColumn("__tb_word", F.shiftright("__tb_cell", 6))
        met = F.getbit("__tb_bits", F.col("__tb_cell").bitwiseAND(F.lit(63))) == 1
        return celled.join(F.broadcast(self.filter), "__tb_word", "left").withColumn(flag, F.coalesce(met, F.lit(False))).drop("__tb_cell", "__tb_word", "__tb_bits")


def lookup(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """Left join of ``rows`` with one row per group in ``groups``; ``size`` is how many of ``rows`` a group has.

    Groups above HOT_SHARE of ``total`` number at most ``1 / HOT_SHARE`` and are broadcast; the rest are shuffled
    and none of them can fill a task.
    """
    limit = max(1000, int(total * HOT_SHARE))
    names = [c for c in groups.columns if c != key]
    hot = groups.where(F.col(size) > limit).select(key, F.struct(*names).alias("__tb_hot"))
    cold = groups.where(F.col(size) <= limit).select(F.col(key).alias("__tb_key"), F.struct(*names).alias("__tb_cold"))
    dealt = rows.join(F.broadcast(hot), key, "left")
    # a row of a hot group has no partner on the cold side: it gets a key of its own, spread over all tasks
    spread = F.when(F.col("__tb_hot").isNull(), F.col(key))
    joined = dealt.where(F.col("__tb_hot").isNotNull()).withColumn("__tb_cold", F.lit(None).cast(cold.schema["__tb_cold"].dataType))
    rest = dealt.where(F.col("__tb_hot").isNull()).withColumn("__tb_key", spread).join(cold, "__tb_key", "left").drop("__tb_key")
    both = joined.unionByName(rest)
    return both.withColumns({c: F.coalesce(F.col("__tb_hot")[c], F.col("__tb_cold")[c]) for c in names}).drop("__tb_hot", "__tb_cold")

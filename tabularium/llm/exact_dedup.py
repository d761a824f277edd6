"""Exact dedup by two-pass Bloom filtering, DataFrame functions only.

A filter (``CountFilter``) has a bounded number of cells; a text's hash has one cell. Pass 1 reads all hashes and counts
the rows of each cell; counts are combined map-side, so a task sends at most one small row for each cell whatever the
rows, and the cells that were met again make the second filter, packed into words and broadcast. Pass 2 reads all hashes
again: a row whose cell was met only once is surely single and passes straight through; only the other rows, the possibly
repeated ones, shuffle, by their full SHA-256. A full filter makes more rows shuffle, never a different result.

Defined results: a null text counts as empty, and empty texts equal each other. Of equal texts the row with the largest
doc_id stays; rows that repeat a doc_id and a text are copies of one document and share its fate, and each counts in
group_size. A null doc_id is smaller than any other. An empty table gives an empty result. Other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import CountFilter, clean_text, lookup, lower_ascii, stash


def text_hash(text="text"):
    return F.sha2(lower_ascii(clean_text(text)), 256)


def duplicate_groups(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256."""
    hashed = stash(docs.select("doc_id", text_hash().alias("text_sha256")), "hashes")
    repeats = CountFilter(hashed, "text_sha256", 2)
    probed = repeats.probe(hashed, "text_sha256")
    single = probed.where(~F.col("__tb_maybe")).select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "text_sha256")
    maybe = probed.where("__tb_maybe").select("doc_id", "text_sha256")
    groups = maybe.groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    found = lookup(maybe, groups, "text_sha256", "group_size", repeats.rows).select(*single.columns)
    return single.unionByName(found).select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that ``duplicate_groups`` does not keep, one row for each document kept; all columns stay.

    Rows with a single text are never shuffled. Of the others only those that stay are: copies leave before the shuffle
    when their group is large.
    """
    hashed = stash(docs.select("doc_id", text_hash().alias("text_sha256")), "hashes")
    repeats = CountFilter(hashed, "text_sha256", 2)
    maybe = repeats.probe(hashed, "text_sha256").where("__tb_maybe")
    groups = maybe.groupBy("text_sha256").agg(F.max("doc_id").alias("__tb_keep"), F.count("*").alias("__tb_size"))
    probed = repeats.probe(docs.withColumn("__tb_sha", text_hash()), "__tb_sha")
    rows = probed.where("__tb_maybe").drop("__tb_maybe")
    named = lookup(rows, groups.withColumnRenamed("text_sha256", "__tb_sha"), "__tb_sha", "__tb_size", repeats.rows)
    kept = named.where(F.col("doc_id").eqNullSafe(F.col("__tb_keep"))).dropDuplicates(["__tb_sha"])
    return probed.where(~F.col("__tb_maybe")).select(*docs.columns).unionByName(kept.select(*docs.columns))

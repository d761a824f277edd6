"""Document sources: files and their hashes, and pages."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: So many files at most are read by a list of their paths; more are found by reading the folders.
MOST_PATHS = 100_000


def files(spark: SparkSession, *roots: str, pattern: str = "*.pdf") -> DataFrame:
    """path, length, modificationTime of the files under the roots, each once; a missing root is an error of the reader.

    Contents are not read.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load([*roots])
    return found.select("path", "length", "modificationTime").dropDuplicates(["path"])


def contents(listed: DataFrame, *roots: str, pattern: str = "*.pdf") -> DataFrame:
    """``listed`` with content; only the listed files are read, unless they are more than MOST_PATHS."""
    spark, paths = listed.sparkSession, [r[0] for r in listed.select("path").limit(MOST_PATHS + 1).collect()]
    reader = spark.read.format("binaryFile")
    if not paths:
        return listed.withColumn("content", F.lit(None).cast("binary"))
    if len(paths) <= MOST_PATHS:
        return reader.load(sorted(paths)).select("path", "content").join(listed, "path")
    return reader.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load([*roots]).select("path", "content").join(listed, "path")


def hashes(listed: DataFrame, *roots: str, cache: DataFrame | None = None) -> DataFrame:
    """path, length, modificationTime, hash_arquivo; contents are read only of files that the cache lacks as they are."""
    keys = ["path", "length", "modificationTime"]
    fresh = listed if cache is None else listed.join(cache.select(*keys), keys, "left_anti")
    hashed = contents(fresh, *roots).select(*keys, F.sha2("content", 256).alias("hash_arquivo"))
    if cache is None:
        return hashed
    return hashed.unionByName(listed.select(*keys).join(cache.select(*keys, "hash_arquivo"), keys))


def pages(read: DataFrame, extract: Callable[[bytes], list[tuple[str, list]]]) -> DataFrame:
    """path, page_no, text, tables, erro of files (path, content).

    ``extract`` is given a file's bytes; its failure is a row, not the job's.
    """
    import pandas as pd

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            rows = []
            for path, content in zip(batch["path"], batch["content"]):
                try:
                    rows += [(path, i, text, tables, None) for i, (text, tables) in enumerate(extract(content), 1)]
                except Exception as error:  # whatever a damaged file provokes belongs to that file
                    rows.append((path, None, None, None, f"{type(error).__name__}: {error}"))
            yield pd.DataFrame(rows, columns=["path", "page_no", "text", "tables", "erro"])

    return read.select("path", "content").mapInPandas(run, "path string, page_no int, text string, tables array<array<array<string>>>, erro string")


def document_text(pages: DataFrame, key: str = "doc_id", most: int | None = None) -> DataFrame:
    """Texts of the first ``most`` pages (all without it) in order, a line break between pages."""
    rows = pages.where(F.col("page_no") <= most) if most else pages
    gathered = F.array_sort(F.collect_list(F.struct("page_no", F.coalesce("text", F.lit("")).alias("text"))))
    return rows.groupBy(key).agg(F.array_join(F.transform(gathered, lambda p: p["text"]), "\n").alias("text"))

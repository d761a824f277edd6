"""Documents read once: a store of decoded pages by what they depend on, and reading by plan.

``decode`` hashes files, plans one file for each hash, asks the store which hashes it lacks under the signature of engine and
rules, decodes those alone, and adds them. A run adds a folder of pages and then, in one small file, its line in the
manifest: pages count from that line on, so a run that dies leaves nothing that is read. ``compact`` makes one run of many.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.duplicates import canonical
from ..sources import documents
from ..sources.scratch import settle
from .taxonomy import Compiled

ENGINE = "tabularium-3"
PAGES = "hash_arquivo string, page_no int, text string, tables array<array<array<string>>>"
FILES = "path string, length long, modificationTime timestamp, hash_arquivo string"
#: Runs that the manifest may have before ``decode`` compacts them.
MOST_RUNS = 50


def signature(rules: Compiled) -> str:
    """Names what an extraction depends on: the engine's version and the rules."""
    return hashlib.sha256((ENGINE + json.dumps(rules, default=lambda o: o.__dict__, sort_keys=True)).encode()).hexdigest()


class Store:
    """Decoded pages by file hash, for one signature; ``path`` is a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, path: str, sign: str):
        self.spark, self.path, self.sign = spark, path.rstrip("/"), sign

    def _read(self, folder: str, schema: str) -> DataFrame | None:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{folder}")
        except Exception as error:  # nothing there yet
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return None

    def runs(self) -> list[str]:
        """Committed runs of the signature, compacted ones left out."""
        found = self._read("manifest", "signature string, run string, replaces array<string>")
        if found is None:
            return []
        rows = found.where(F.col("signature") == self.sign).select("run", "replaces").collect()
        gone = {r for row in rows for r in row.replaces or []}
        return sorted(r.run for r in rows if r.run not in gone)

    def _commit(self, run: str, replaces: list[str]) -> None:
        line = self.spark.createDataFrame([(self.sign, run, replaces)], "signature string, run string, replaces array<string>")
        line.coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")

    def _runs(self, kind: str, schema: str) -> DataFrame:
        runs = self.runs()
        if not runs:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.path}/{kind}/{self.sign}/{r}" for r in runs))

    def pages(self) -> DataFrame:
        return self._runs("pages", PAGES)

    def missing(self, hashed: DataFrame) -> DataFrame:
        """Rows of ``hashed`` whose hash_arquivo no committed run has."""
        return hashed.join(self._runs("hashes", "hash_arquivo string"), "hash_arquivo", "left_anti")

    def add(self, pages: DataFrame, hashed: DataFrame, replaces: list[str] | None = None) -> None:
        """``hashed``: the files that were decoded, those without pages among them."""
        run = uuid.uuid4().hex
        pages.select("hash_arquivo", "page_no", "text", "tables").write.parquet(f"{self.path}/pages/{self.sign}/{run}")
        hashed.select("hash_arquivo").distinct().write.parquet(f"{self.path}/hashes/{self.sign}/{run}")
        self._commit(run, replaces or [])

    def compact(self) -> None:
        """One run of all; the old ones are no longer read, and may be deleted when no job reads them."""
        old = self.runs()
        if len(old) > 1:
            self.add(self.pages(), self._runs("hashes", "hash_arquivo string"), old)

    def known_files(self) -> DataFrame | None:
        """Hashes of files as they were when they were read, whatever the rules."""
        return self._read("files", FILES)

    def add_files(self, hashed: DataFrame) -> None:
        hashed.select(*(f.split()[0] for f in FILES.split(", "))).write.mode("append").parquet(f"{self.path}/files")


def decode(hashed: DataFrame, contents: Callable[[DataFrame], DataFrame], extract: Callable[[bytes], list], store: Store | None = None) -> tuple[DataFrame, DataFrame]:
    """Pages of the files in ``hashed`` (path, hash_arquivo), one file for each hash, and the others as (path, canonico, hash_arquivo).

    Pages: doc_id and path (of the file that stands for its hash), page_no, text, tables, erro, hash_arquivo.
    ``contents`` gives (path, content) of the listed files. What fails to decode is not stored, so it is tried again.
    """
    plan = settle(canonical(hashed.select("path", "hash_arquivo"), "hash_arquivo", "path"), "plan")
    first = plan.where("path = canonico").select("path", "hash_arquivo")
    fresh = settle(store.missing(first) if store else first, "fresh")
    made = settle(documents.pages(contents(fresh), extract).join(fresh, "path"), "decoded")
    if store and not fresh.isEmpty():
        good = made.where("erro is null")
        store.add(good, fresh.join(made.where("erro is not null").select("path"), "path", "left_anti"))
        if len(store.runs()) > MOST_RUNS:
            store.compact()
    columns = ["path", "page_no", "text", "tables", "erro", "hash_arquivo"]
    pages = made.select(*columns)
    if store:
        known = store.pages().join(first, "hash_arquivo").withColumn("erro", F.lit(None).cast("string")).select(*columns)
        pages = known.unionByName(made.where("erro is not null").select(*columns))
    return pages.withColumn("doc_id", F.col("path")), plan.where("path <> canonico").select("path", "canonico", "hash_arquivo")


def read_files(spark: SparkSession, roots: list[str], extract: Callable[[bytes], list], pattern: str = "*.pdf", store: Store | None = None) -> tuple[DataFrame, DataFrame]:
    """``decode`` of the files under ``roots``; with a store, files that are as they were are not hashed again."""
    listed = documents.files(spark, *roots, pattern=pattern)
    known = store.known_files() if store else None
    hashed = settle(documents.hashes(listed, *roots, cache=known), "hashed")
    if store:
        store.add_files(hashed if known is None else hashed.join(known, ["path", "length", "modificationTime"], "left_anti"))
    return decode(hashed, lambda files: documents.contents(files.select("path"), *roots, pattern=pattern), extract, store)

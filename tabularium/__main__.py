"""Command line: ``python -m tabularium extract|classify|document --input FOLDER... --taxonomy FOLDER --output PATH``.

Documents are files that ``--decoder module:function`` turns into pages (bytes -> list of (text, tables)), or a table of
pages (``--pages``: doc_id, page_no, text, tables). Exit status 1: the single document is missing or could not be read.
"""

from __future__ import annotations

import argparse
import importlib
import logging
import time
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .plans import batch, store, taxonomy
from .session import session
from .sources import documents, sinks

log = logging.getLogger("tabularium")


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="tabularium", description=__doc__)
    p.add_argument("mode", choices=["extract", "classify", "document"])
    p.add_argument("--input", nargs="+", default=[], help="folders of documents (document: one file)")
    p.add_argument("--pages", help="a table of pages instead")
    p.add_argument("--pattern", default="*.pdf")
    p.add_argument("--decoder", help="module:function from a file's bytes to its pages")
    p.add_argument("--taxonomy", default=None, help="folder of the rule tables; else TAXONOMY_FILE, else config/taxonomy")
    p.add_argument("--taxonomy-kind", default="json", choices=["json", "csv", "parquet"])
    p.add_argument("--output", required=True)
    p.add_argument("--store", help="folder of decoded documents: what it has under the same rules is not decoded again")
    p.add_argument("--kind", default="parquet", choices=["parquet", "csv", "json", "jsonl", "xlsx"])
    p.add_argument("--classify-pages", type=int, default=3, help="pages that classify mode reads; 0: all")
    p.add_argument("--preclassify-pages", type=int, default=3, help="pages that decide whether a document is read in full; 0: always")
    return p.parse_args(argv)


def read_pages(spark: SparkSession, args: argparse.Namespace, rules: taxonomy.Compiled) -> tuple[DataFrame, DataFrame | None]:
    """The pages, and the files that were not read because another has their bytes."""
    if args.pages:
        return spark.read.parquet(args.pages), None
    if not args.decoder or not args.input:
        raise SystemExit("give --pages, or --input and --decoder")
    module, name = args.decoder.split(":")
    extract = getattr(importlib.import_module(module), name)
    if args.mode == "document":
        read = spark.read.format("binaryFile").load(args.input[0]).select("path", "content")
        hashed = read.select("path", F.sha2("content", 256).alias("hash_arquivo"))
        return documents.pages(read, extract).withColumn("doc_id", F.col("path")).join(hashed, "path"), None
    kept = store.Store(spark, args.store, store.signature(rules)) if args.store else None
    return store.read_files(spark, args.input, extract, args.pattern, kept)


def main(argv: list[str] | None = None) -> int:
    args = arguments(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    began, spark = time.time(), session()
    tables = taxonomy.load(spark, args.taxonomy or taxonomy.resolve("."), args.taxonomy_kind)
    taxonomy.check(spark, tables)
    rules = taxonomy.compile_rules(tables)
    for fault in rules.faults:
        log.warning("regra em quarentena: %s", fault)
    if args.mode == "extract":
        taxonomy.check_output_model(tables)
    try:
        pages, copies = read_pages(spark, args, rules)
    except Exception as error:
        if args.mode != "document" or "PATH_NOT_FOUND" not in str(error):
            raise
        log.error("%s: not found", args.input[0])
        return 1
    stamp = datetime.now(UTC).strftime("%d/%m/%Y %H:%M:%S")
    if args.mode == "classify":
        made = {"classification_report": batch.classify_batch(pages, rules, args.classify_pages, copies)}
        made["classification_report"].write.mode("overwrite").option("header", "true").format("csv" if args.kind in ("csv", "xlsx") else "parquet").save(args.output)
        counts = made["classification_report"].groupBy("status").count().collect()
    else:
        made = batch.run(pages, rules, args.preclassify_pages if args.mode == "extract" else 0, taxonomy.output_tabs(tables) if args.mode == "extract" else None, copies)
        report = made.pop("resumo").persist()
        counts = report.groupBy("status").count().collect()
        if args.mode == "document":
            made.pop("duplicate_audit")
            if report.where("status = 'erro'").count():
                log.error("%s: %s", args.input[0] if args.input else args.pages, report.first().erro)
                return 1
            if all(made[n].isEmpty() for n in ("results_extract", "sample", "client")):
                log.warning("nothing was extracted")
                return 0
        sinks.save(made, args.output, args.kind, stamp)
        report.coalesce(1).write.mode("overwrite").option("header", "true").csv(f"{args.output.rstrip('/')}_resumo")
    log.info("%s in %.0f s", ", ".join(f"{r['status']}: {r['count']}" for r in sorted(counts)), time.time() - began)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())

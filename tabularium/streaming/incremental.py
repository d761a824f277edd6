"""Incremental runs: documents arrive as files, are classified as they come, and none is extracted twice.

What a cache of extractions does is here a file source with a checkpoint, and a store that
each micro-batch anti-joins, so that a batch that is run again after a failure adds nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.classify import DetectionRule, Template, classification_summary, classify


def watch(spark: SparkSession, path: str, schema: str, files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def classify_stream(docs: DataFrame, templates: list[Template], rules: list[DetectionRule], key: str = "doc_id") -> DataFrame:
    """Scores need one document only, so the stream holds no state."""
    return classification_summary(classify(docs, templates, rules), key)


def store_new(stream: DataFrame, store: str, checkpoint: str, key: str = "doc_id") -> StreamingQuery:
    """Append to the store the rows whose key it lacks; ends when all files there are have been read."""

    def add(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        fresh = batch.dropDuplicates([key])
        try:
            known = spark.read.parquet(store).select(key)
        except Exception as error:  # the first batch finds no store
            if "PATH_NOT_FOUND" not in str(error):
                raise
        else:
            fresh = fresh.join(known, key, "left_anti")
        fresh.write.mode("append").parquet(store)

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

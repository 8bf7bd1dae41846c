"""Incremental pickup of daily drop files with Structured Streaming.

A file source with ``trigger(availableNow=True)`` processes every file not
seen before and stops; the checkpoint records which files were processed, so
a rerun (or a restart after lost executors) never loads a file twice. With
``archive_dir`` Spark moves processed files there (``cleanSource``); the move
can lag one batch behind, so the checkpoint, not the archive, is the proof of
processing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimledger.sources.readers import BAD_LINE

__all__ = ["ingest_files", "ingest_names", "batch_partition_writer"]


def ingest_files(spark: SparkSession, source_dir: str, schema: T.StructType, checkpoint: str,
                 on_batch: Callable[[DataFrame, int], None], fmt: str = "csv", sep: str = ";",
                 header: bool = True, archive_dir: str | None = None,
                 max_files_per_trigger: int | None = None, pattern: str | None = None):
    """Run ``on_batch(df, batch_id)`` over all new files in ``source_dir`` and stop.

    ``df`` carries a ``source_file`` column and, for csv, ``_bad_line``: the
    text of a line that does not fit the schema, NULL otherwise. A csv header
    must name the schema's columns in their order, or the run fails before
    the file counts as processed. ``on_batch`` should write
    idempotently for its ``batch_id`` (e.g. dynamic partition overwrite),
    because a batch that failed half-way is replayed with the same id.
    """
    read_schema = T.StructType([*schema.fields, T.StructField(BAD_LINE, T.StringType())]) if fmt == "csv" else schema
    reader = spark.readStream.schema(read_schema).format(fmt)
    if fmt == "csv":
        reader = (reader.option("sep", sep).option("header", header).option("enforceSchema", False)
                  .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD_LINE))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    stream = reader.load(source_dir).withColumn("source_file", F.col("_metadata.file_path"))
    if fmt == "csv":
        # Whether a line is bad depends on all its columns, so none may be pruned from the read.
        stream = stream.where(F.xxhash64(*schema.fieldNames()) >= F.lit(-2 ** 63))
    query = (stream.writeStream.foreachBatch(on_batch)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def ingest_names(spark: SparkSession, source_dir: str, checkpoint: str,
                 on_batch: Callable[[DataFrame, int], None], archive_dir: str | None = None,
                 max_files_per_trigger: int | None = None, pattern: str | None = None):
    """Run ``on_batch(df, batch_id)`` over the names (column ``path``) of all new
    files in ``source_dir`` and stop. For folders of several kinds of files:
    the batch routes each to its own reader. The contents are pruned from the
    stream's scan."""
    reader = spark.readStream.format("binaryFile").schema(
        "path string, modificationTime timestamp, length long, content binary")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    query = (reader.load(source_dir).select("path").writeStream.foreachBatch(on_batch)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def batch_partition_writer(path: str, fmt: str = "parquet"):
    """An ``on_batch`` that writes each micro-batch as the partition
    ``batch_id=<id>`` of ``path`` with dynamic overwrite: a batch replayed
    after a failure replaces its own partition instead of adding a copy."""
    def write(df: DataFrame, batch_id: int) -> None:
        (df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").format(fmt).save(path))
    return write

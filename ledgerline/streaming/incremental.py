"""Incremental ingest: new raw CSV files merged into the warehouse.

The batch job is meant to be re-run on a schedule and relies on keyed
upserts to stay idempotent.  This module expresses the same thing with
Structured Streaming: a file source picks up only files it has not seen
(tracked in the stream's checkpoint), and every micro-batch runs the quality
rules and merges its clean rows into the current published version through
the staged, all-or-nothing load.  With ``availableNow`` the query processes
what has arrived and stops, so a scheduler can start it like a batch job.

The stream carries file paths only; each micro-batch reads its files with the
batch reader, so columns are mapped by each file's own header, missing columns
raise and extra ones are reported, exactly as in a batch run.

A replayed micro-batch is applied once: the manifest that publishes a version
also holds the stream's last epoch, and an epoch already in it is skipped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ledgerline.plans.pipeline import load_star, prepare
from ledgerline.plans.publish import Warehouse
from ledgerline.rules import RETAIL_RULES, SalesRules
from ledgerline.session import cut_scope
from ledgerline.sources.csv import CSV_FILES, read_csv_strings


def file_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming paths of new CSV files; file contents are not read here."""
    reader = (spark.readStream.format("binaryFile")
              .schema("path string, modificationTime timestamp, length long, content binary")
              .option("pathGlobFilter", CSV_FILES).option("recursiveFileLookup", True))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(source_dir).where("length > 0").select("path")


def merge_batch(warehouse: Warehouse, rules: SalesRules, stream: str | None = None):
    """The ``foreachBatch`` function: quality rules, merge, staged publish.

    ``stream`` names the stream in the manifest (default: the query's id,
    which lives as long as its checkpoint).
    """

    def apply(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        name = stream or spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "stream"
        last = warehouse.published_epoch(name)
        if last is not None and epoch_id <= last:
            return
        paths = [r.path for r in batch.collect()]
        if not paths:
            return
        with cut_scope(spark):
            prepared = prepare(read_csv_strings(spark, paths), rules)
            warehouse.load(load_star(warehouse, prepared), run_id=f"{name}-{epoch_id:012d}", epochs={name: epoch_id})

    return apply


def start_ingest(spark: SparkSession, source_dir: str, warehouse_root: str, checkpoint_location: str,
                 rules: SalesRules = RETAIL_RULES, available_now: bool = True,
                 processing_time: str | None = None, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the ingest stream; ``checkpoint_location`` must be shared storage."""
    writer = (file_stream(spark, source_dir, max_files_per_trigger).writeStream
              .foreachBatch(merge_batch(Warehouse(spark, warehouse_root), rules))
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime=processing_time or "1 day")
    return writer.start()

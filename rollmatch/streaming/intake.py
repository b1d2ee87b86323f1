"""Incremental intake: roster batch files arriving in a folder, appended to a Parquet snapshot.

The batch intake (``plans.intake``) re-reads a folder each time a new batch is
edited in by hand. Run as a Structured Streaming file source instead, each new
CSV file is read exactly once, cleaned with the same column rules, filtered to
rows with both ids and appended to the snapshot; the checkpoint location (in
the shared checkpoint folder) records which files were taken, so a restarted or
failed run continues where it stopped.

``trigger(availableNow=True)`` processes everything present and stops, which is
how a batch drop is handled; a long-running trigger keeps watching the folder.
Width problems are not raised mid-stream: every row carries ``bad_width`` and
``sources.csv.folder_report`` on a scan of the folder lists affected files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rollmatch.operators.cleaning import prepare_side
from rollmatch.schema import INTAKE_NAMES, Side, roster_schema
from rollmatch.sources.csv import CORRUPT, SOURCE_BATCH, SOURCE_FILE, normalize, reader_options, reject_hidden_csv


def start_intake_stream(spark: SparkSession, folder: str, side: Side, sink: str, checkpoint: str,
                        blank: str = "empty", encoding: str = "UTF-8", multiline: bool = True,
                        available_now: bool = True, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the stream; returns the running query (``awaitTermination`` for availableNow).

    Each micro-batch is cleaned as a static frame (so rows get their position in the
    file) and written to ``<sink>/batch_id=<n>`` in overwrite mode: a micro-batch that
    is replayed after a failure rewrites its own folder, so the snapshot holds every
    file exactly once. ``spark.read.parquet(sink)`` reads all batches.
    """
    reject_hidden_csv(spark, folder)
    opts = reader_options(INTAKE_NAMES, "lenient", encoding, multiline)
    opts.pop("recursiveFileLookup")
    if max_files_per_trigger:
        opts["maxFilesPerTrigger"] = max_files_per_trigger
    raw = (spark.readStream.schema(roster_schema(INTAKE_NAMES, CORRUPT)).options(**opts).csv(folder)
           .select("*", F.col("_metadata.file_name").alias(SOURCE_FILE)))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        placed = normalize(batch, INTAKE_NAMES, blank).withColumn(SOURCE_BATCH, F.lit(batch_id).cast("int"))
        rows = prepare_side(placed, side)
        rows.write.mode("overwrite").parquet(f"{sink.rstrip('/')}/batch_id={batch_id}")

    writer = raw.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()

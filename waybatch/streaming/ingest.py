"""Route delivery CSV files as they arrive.

The file source keeps track of files already seen in its checkpoint. Each
micro-batch's files are checked and read like any delivery CSV (columns by
name, bad files skipped), routed with the batch operators and appended to the
route table. Batches of ``batch_size`` rows are cut inside each micro-batch,
in file order. Each micro-batch is appended under an id made of the stream's
checkpoint folder and its epoch, so that it is stored once: after a failure
between an append and the stream's commit the epoch runs again and finds its
rows stored.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from waybatch.operators.batching import FILE_ORDER
from waybatch.operators.quality import quality_report, raise_on_failure
from waybatch.operators.routing import optimize_routes
from waybatch.operators.sequence import BLOCK_COL, FILE_COL
from waybatch.schema import DELIVERY_TEXT_SCHEMA
from waybatch.sinks import manifest
from waybatch.sinks.routes import append_routes, is_table_name
from waybatch.sources.files import IngestError, read_delivery_csv, typed_deliveries


def delivery_stream(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = (
        spark.readStream.schema(DELIVERY_TEXT_SCHEMA)
        .option("header", "true")
        .option("pathGlobFilter", "*.csv")
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = reader.csv(folder)
    return df.select(
        "*",
        F.col("_metadata.file_path").alias(FILE_COL),
        F.col("_metadata.file_block_start").alias(BLOCK_COL),
    )


def start_route_stream(
    spark: SparkSession,
    folder: str,
    target_path: str,
    checkpoint_location: str,
    batch_size: int = 100,
    mode: str = "nearest",
    strict: bool = True,
    available_now: bool = True,
) -> StreamingQuery:
    """Starts the query; ``available_now`` processes what is there and stops.
    A folder ``target_path`` stores each micro-batch once; a catalog table at
    least once."""
    stream_id = hashlib.sha256(checkpoint_location.rstrip("/").encode()).hexdigest()[:16]

    def handle(batch: DataFrame, epoch_id: int) -> None:
        append_id = f"{stream_id}-{epoch_id}"
        if not is_table_name(target_path) and append_id in {c["batch_id"] for c in manifest.commits(spark, target_path)}:
            return
        if batch.isEmpty():
            return
        named = [r[FILE_COL] for r in batch.select(FILE_COL).distinct().collect()]  # bounded by the trigger
        try:
            text = read_delivery_csv(batch.sparkSession, named)
        except IngestError:
            return
        if strict:
            raise_on_failure(quality_report(text, source_col=FILE_COL))
        routes = optimize_routes(typed_deliveries(text), order_by=FILE_ORDER, batch_size=batch_size, mode=mode)
        append_routes(batch.sparkSession, routes, target_path, batch_id=None if is_table_name(target_path) else append_id)

    writer = delivery_stream(spark, folder).writeStream.foreachBatch(handle).option(
        "checkpointLocation", checkpoint_location
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()

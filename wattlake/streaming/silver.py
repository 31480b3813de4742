"""Bronze to Silver as a Structured Streaming job that stops when it has caught up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.plans.silver import STREAMS, silver_rows
from wattlake.session import require_utc
from wattlake.sources.bronze import document_schema, file_in, with_stamp
from wattlake.sources.files import join_path
from wattlake.sources.ledger import record_load
from wattlake.sources.tables import upsert


def checkpoint_path(lake: str, table: str) -> str:
    return join_path(lake, "_state", f"stream_silver_{table}")


def load_available(
    spark: SparkSession,
    lake: str,
    table: str,
    layout: str = "files",
    files_per_batch: int | None = None,
) -> int:
    """Merge every Bronze file the checkpoint has not seen; returns the micro-batches merged.

    A micro-batch's number is stored with what it publishes, under the query's id, which lives as
    long as the checkpoint: one repeated after a failure is recognised and skipped.
    Files may be split over micro-batches in any order, so a stored row gives way only to a
    later ingestion.  Unlike the batch load, a file stamped before already loaded ones is
    picked up too: the checkpoint remembers files, not a mark.
    """
    require_utc(spark)
    stream = STREAMS[table]
    reader = spark.readStream.schema(document_schema(layout))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    documents = with_stamp(
        reader.text(stream.bronze(lake), wholetext=layout == "files"), layout
    )

    merged: list[int] = []

    def merge(batch: DataFrame, batch_id: int) -> None:
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        done = upsert(
            silver_rows(batch, stream), stream.silver(lake), stream.contract, newer_only=True,
            batch=(query_id, batch_id),
        )
        # named here as well, in case the ledger was not yet written when the batch was lost
        named = batch.select(file_in(F.col("source_file")).alias("file"), "stamp").distinct()
        record_load(batch.sparkSession, lake, table, named, f"{query_id}-{batch_id}")
        if done:
            merged.append(batch_id)

    query = (
        documents.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint_path(lake, table))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    # the query's own progress history is cut to a setting
    return len(merged)

"""Silver loads: incremental with a high-water mark, and full rebuilds."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.functions.times import utc
from wattlake.operators.dedupe import deduplicate
from wattlake.operators.flatten import (
    POSITION,
    add_partition_columns,
    flatten_flows,
    flatten_mix,
)
from wattlake.schemas import FLOWS, MIX, TableContract
from wattlake.session import require_utc
from wattlake.sources import files
from wattlake.sources.bronze import file_in, listing, next_batch, records_in, records_since
from wattlake.sources.ledger import forget_loads, late_files, record_load
from wattlake.sources.state import keep_mark, mark_path, read_mark, write_mark
from wattlake.sources.tables import replace_table, staged, table_path, upsert


@dataclass(frozen=True)
class Stream:
    """A Bronze stream and the Silver table it feeds; both have the same name."""

    contract: TableContract
    flatten: Callable[..., DataFrame]

    @property
    def name(self) -> str:
        return self.contract.name

    def bronze(self, lake: str) -> str:
        return table_path(lake, "bronze", self.name)

    def silver(self, lake: str) -> str:
        return table_path(lake, "silver", self.name)


STREAMS = {
    MIX.name: Stream(MIX, flatten_mix),
    FLOWS.name: Stream(FLOWS, flatten_flows),
}


def silver_rows(records: DataFrame, stream: Stream) -> DataFrame:
    """Flat rows of a set of documents, the newest ingestion per key, ready to be merged.

    Equal ingestion times go to the later file name and then the later position in the file;
    names are carried without their stamp, which is equal then, to keep shuffled rows short.
    A document whose own ``ingested_at`` differs from the stamp it is stored under fails the
    load: the mark is taken from stamps and could otherwise pass over documents.
    """
    name = F.substring_index("source_file", "/", -1)
    named = records.withColumn("file_rest", F.regexp_replace(name, r"^\d{8}T\d{12}Z", ""))
    flat = stream.flatten(named, carry=["file_rest", "stamp"])
    agreed = F.when(F.col("ingested_at") == F.col("stamp"), F.col("ingested_at")).otherwise(
        F.raise_error(
            F.concat(
                F.lit("ingested_at differs from the stamp "), F.col("stamp").cast("string")
            )
        )
    )
    latest = deduplicate(
        flat.withColumn("ingested_at", agreed).drop("stamp"),
        stream.contract.key,
        tie_break=["file_rest", POSITION],
    ).drop("file_rest", POSITION)
    return add_partition_columns(latest)


def load_new_bronze(
    spark: SparkSession,
    lake: str,
    table: str,
    now: datetime | None = None,
    layout: str = "files",
    newer_only: bool = False,
) -> int:
    """Load what was landed after the table's mark, and return the number of files.

    A mark that had to be derived from the table is stored before the merge begins, and the new
    one after it has ended.  Whatever a lost driver leaves in between, the next run starts from
    the old mark and merges the same files again.  The ledger gets the files as they were listed
    before reading, so that one arriving meanwhile is at worst named late although it was read.
    """
    require_utc(spark)
    stream = STREAMS[table]
    root = stream.bronze(lake)
    batch = next_batch(spark, root, keep_mark(spark, lake, stream.contract), now, layout)
    if batch.files == 0:
        return 0
    records = records_since(spark, root, batch.after, now, batch.upto, layout)
    upsert(silver_rows(records, stream), stream.silver(lake), stream.contract, newer_only)
    record_load(spark, lake, table, batch.listing, f"{utc(batch.upto):%Y%m%dT%H%M%S%fZ}")
    write_mark(spark, lake, table, batch.upto)
    return batch.files


def find_late(spark: SparkSession, lake: str, table: str, layout: str = "files") -> DataFrame:
    """(file, stamp) of the Bronze files that the mark has passed over and no load has taken."""
    stream = STREAMS[table]
    mark = read_mark(spark, lake, stream.contract)
    return late_files(spark, lake, table, stream.bronze(lake), mark, layout)


def load_late(spark: SparkSession, lake: str, table: str, layout: str = "files") -> int:
    """Merge the files that :func:`find_late` names, and return their number; the mark stays.

    A stored row with a later ingestion is kept, as it would have been had the file come in time.
    Only the day folders with late files are read.
    """
    require_utc(spark)
    stream = STREAMS[table]
    root = stream.bronze(lake)
    with staged(find_late(spark, lake, table, layout), "late-files") as late:
        count = late.count()
        if not count:
            return 0
        # calendar days of ingestion
        days = late.select(F.regexp_extract("file", r"^(year=[^/]+/month=[^/]+/day=[^/]+)/", 1)).distinct()
        folders = sorted(files.join_path(root, row[0]) for row in days.collect())
        records = records_in(spark, root, folders, layout)
        wanted = records.join(
            late.select(F.col("file").alias("_late")), file_in(F.col("source_file")) == F.col("_late"), "left_semi"
        )
        upsert(silver_rows(wanted, stream), stream.silver(lake), stream.contract, newer_only=True)
        record_load(spark, lake, table, late, f"late-{uuid.uuid4().hex}")
        return count


def rebuild(spark: SparkSession, lake: str, table: str, layout: str = "files") -> None:
    """Recompute a Silver table from all of Bronze and put it in place of the old one.

    The mark is dropped; the next incremental load derives it from the new table.  It goes
    first, so that an interrupted rebuild cannot leave a mark without the rows behind it.  The ledger
    starts anew with all files listed before reading.
    """
    require_utc(spark)
    stream = STREAMS[table]
    found = listing(spark, stream.bronze(lake), layout=layout)
    records = records_since(spark, stream.bronze(lake), layout=layout)
    files.delete(spark, mark_path(lake, table))
    replace_table(silver_rows(records, stream), stream.silver(lake), stream.contract)
    forget_loads(spark, lake, table)
    record_load(spark, lake, table, found, "rebuild")

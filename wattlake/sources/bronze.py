"""Bronze: raw JSON documents in an envelope, partitioned by ingestion day.

Two layouts hold the same documents:

* ``files``: one document per file, named by its ingestion stamp,
  ``year=/month=/day=/<stamp>[_suffix].json``; documents may span several lines.  Written by
  :func:`land_files`, or by whatever else fetches documents.
* ``lines``: written by :func:`land`; one document per line, many per file, in a folder per
  landed batch: ``year=/month=/day=/ingested=<stamp>/part-*``.  Batches can be selected by
  partition pruning alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import UTC, datetime, timedelta

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.functions.times import (
    FILE_STAMP_LENGTH,
    date_parts,
    format_iso,
    format_stamp,
    instant,
    parse_stamp,
    utc,
)
from wattlake.sources import files

DAY_FOLDERS = "year string, month string, day string"
EMPTY = f"value string, source_file string, stamp timestamp, {DAY_FOLDERS}"


def envelope(
    response: Column, source_url: Column, ingested_at: Column, one_line: bool = True
) -> Column:
    """The stored document: ingestion metadata around the response, kept as received, but for
    line breaks where a document must be ``one_line``.

    A null response is an error: its empty line would make every load that covers it fail.
    """
    head = F.to_json(
        F.struct(
            format_iso(ingested_at).alias("ingested_at"),
            F.coalesce(source_url, F.lit("")).alias("source_url"),
        )
    )
    body = F.when(
        response.isNotNull(), F.regexp_replace(response, r"[\r\n]+", " ") if one_line else response
    ).otherwise(F.raise_error(F.lit("cannot land a null response")))
    return F.concat(F.rtrim(head, F.lit("}")), F.lit(',"response":'), body, F.lit("}"))


def land(
    documents: DataFrame,
    root: str,
    response: str = "response",
    source_url: str = "source_url",
    ingested_at: str = "ingested_at",
) -> None:
    """Append raw responses to Bronze.

    ``ingested_at`` is the moment of a landed batch, so it has few distinct values: each gets a
    folder.  A batch holding most of the rows is split over several files by the rebalance.
    """
    moment = F.col(ingested_at)
    folders = {**date_parts(moment), "ingested": format_stamp(moment)}
    (
        documents.select(
            envelope(F.col(response), F.col(source_url), moment).alias("value"),
            *(part.alias(name) for name, part in folders.items()),
        )
        .hint("rebalance", *folders)
        .write.mode("append")
        .partitionBy(*folders)
        .text(root)
    )


def land_files(
    documents: DataFrame,
    root: str,
    response: str = "response",
    source_url: str = "source_url",
    ingested_at: str = "ingested_at",
) -> int:
    """Write each raw response as a file of its own, and return how many documents that were.

    The executors write the files, in the ``files`` layout.  A name is the stamp and a hash of the
    document, and a file is renamed into place when it is complete: a task that runs twice leaves
    the same files, and readers never see half of one.  ``root`` is a path or URI that Arrow's file
    systems open on the executors (local, HDFS, S3, GCS).
    """
    moment = F.col(ingested_at)
    text = envelope(F.col(response), F.col(source_url), moment, one_line=False)
    folder = F.concat_ws("/", *(F.concat(F.lit(f"{k}="), part) for k, part in date_parts(moment).items()))
    named = documents.select(folder.alias("folder"), format_stamp(moment).alias("stamp"), text.alias("text")).select(
        "folder",
        F.concat("stamp", F.lit("_"), F.substring(F.sha2("text", 256), 1, 16), F.lit(".json")).alias("name"),
        "text",
    )

    # Hadoop writes local URIs with one slash, which Arrow does not know
    place_of_root = re.sub(r"^file:/+", "/", root.rstrip("/"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, top = fs.FileSystem.from_uri(place_of_root)
        attempt = TaskContext.get().taskAttemptId()
        known = set()
        for batch in batches:
            for row in batch.to_pylist():
                place = f"{top}/{row['folder']}"
                if place not in known:
                    store.create_dir(place, recursive=True)
                    known.add(place)
                hidden = f"{place}/.{row['name']}.{attempt}"
                with store.open_output_stream(hidden) as out:
                    out.write(row["text"].encode("utf-8"))
                store.move(hidden, f"{place}/{row['name']}")
            yield pa.RecordBatch.from_pydict({"written": [batch.num_rows]})

    total = named.mapInArrow(write, "written long").agg(F.sum("written").alias("n")).first()["n"]
    return total or 0


def day_folders(
    spark: SparkSession, root: str, after: datetime | None, now: datetime | None
) -> list[str]:
    """The folders that can hold documents ingested after ``after``.

    All of Bronze without a mark; otherwise the existing day folders from the mark's day to
    ``now``'s, so that neither Spark nor the driver lists the older history.
    """
    if after is None:
        return [root] if files.children(spark, root) else []
    first, last = utc(after).date(), utc(now or datetime.now(UTC)).date()
    days = [first + timedelta(days=n) for n in range((last - first).days + 1)]
    known_months: dict[str, list[str]] = {}
    folders = []
    for day in days:
        month = files.join_path(root, f"year={day:%Y}", f"month={day:%m}")
        if month not in known_months:
            known_months[month] = files.children(spark, month)
        if f"day={day:%d}" in known_months[month]:
            folders.append(files.join_path(month, f"day={day:%d}"))
    return folders


def _stamp(path: Column, layout: str) -> Column:
    if layout == "lines":
        return parse_stamp(F.regexp_extract(path, r"/ingested=([^/]+)/", 1))
    return parse_stamp(F.substring(F.substring_index(path, "/", -1), 1, FILE_STAMP_LENGTH))


def _between(stamp: Column, after: datetime | None, upto: datetime | None) -> Column:
    test = F.lit(True)
    if after is not None:
        test = test & (stamp > instant(after))
    if upto is not None:
        test = test & (stamp <= instant(upto))
    return test


def file_in(path: Column) -> Column:
    """A Bronze file by its path below the stream's folder, the same for every spelling of the root."""
    return F.regexp_extract(path, r"(year=[^/]+/month=[^/]+/day=[^/]+/.+)$", 1)


@dataclass(frozen=True)
class Batch:
    """A fixed set of Bronze files: those stamped after ``after`` and up to ``upto``.

    ``listing`` has them as (file, stamp), as they were found before anything was read.
    """

    files: int
    after: datetime | None
    upto: datetime | None
    listing: DataFrame | None = field(default=None, compare=False)


def listing(
    spark: SparkSession, root: str, after: datetime | None = None, now: datetime | None = None,
    upto: datetime | None = None, layout: str = "files",
) -> DataFrame:
    """(file, stamp) of the files stamped in a period, by their paths alone.

    The binary-file source skips the content when it is not selected.
    """
    folders = day_folders(spark, root, after, now)
    if not folders:
        return spark.createDataFrame([], "file string, stamp timestamp")
    listed = spark.read.format("binaryFile").option("basePath", root).load(folders)
    return listed.select(
        file_in(F.col("path")).alias("file"), _stamp(F.col("path"), layout).alias("stamp")
    ).filter(_between(F.col("stamp"), after, upto))


def next_batch(
    spark: SparkSession,
    root: str,
    after: datetime | None = None,
    now: datetime | None = None,
    layout: str = "files",
) -> Batch:
    """Number of files newer than the mark, and the newest stamp among them.

    Taking the upper bound before the load means a file arriving in between waits for the
    next run instead of being passed over by the mark.
    """
    found = listing(spark, root, after, now, layout=layout)
    summary = found.agg(
        F.count(F.lit(1)).alias("files"), format_iso(F.max("stamp")).alias("newest")
    ).first()
    if not summary["files"]:
        return Batch(0, after, after)
    newest = datetime.fromisoformat(summary["newest"])
    return Batch(summary["files"], after, newest, found.filter(_between(F.col("stamp"), None, newest)))


def records_since(
    spark: SparkSession,
    root: str,
    after: datetime | None = None,
    now: datetime | None = None,
    upto: datetime | None = None,
    layout: str = "files",
) -> DataFrame:
    """Raw documents ingested after ``after``: text, file, stamp and day folder strings."""
    folders = day_folders(spark, root, after, now)
    return records_in(spark, root, folders, layout).filter(_between(F.col("stamp"), after, upto))


def records_in(
    spark: SparkSession, root: str, folders: list[str], layout: str = "files"
) -> DataFrame:
    """Raw documents of the given folders below the root."""
    if not folders:
        return spark.createDataFrame([], EMPTY)
    raw = (
        spark.read.schema(document_schema(layout))
        .option("basePath", root)
        .text(folders, wholetext=layout == "files")
    )
    return with_stamp(raw, layout)


def document_schema(layout: str) -> str:
    folders = f"{DAY_FOLDERS}, ingested string" if layout == "lines" else DAY_FOLDERS
    return f"value string, {folders}"


def with_stamp(raw: DataFrame, layout: str) -> DataFrame:
    """Name the file each document came from and the stamp it was ingested at."""
    stamp = F.col("ingested" if layout == "lines" else "_metadata.file_name")
    return raw.select(
        "value",
        F.col("_metadata.file_path").alias("source_file"),
        parse_stamp(stamp).alias("stamp"),
        "year",
        "month",
        "day",
    )


def provenance(records: DataFrame, scheme: str, value: str = "value") -> DataFrame:
    """Documents whose ``source_url`` starts with the given scheme."""
    return records.filter(F.get_json_object(value, "$.source_url").startswith(scheme))

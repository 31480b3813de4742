"""Silver and Gold tables: partitioned Parquet, validated before anything becomes visible.

Every write is staged by Spark and published when the whole job has succeeded, so a lost
executor or a broken rule leaves the table as it was.  Publishing moves the staged folders into
the table one by one: on plain Parquet it is not atomic for readers, but a note names the staged
folders until all are moved, and whoever opens the table for writing next moves the rest.  Tables of
a catalog that supports row-level changes use :func:`merge_into_catalog` instead.
"""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.operators.contract import conform, guard
from wattlake.operators.dedupe import deduplicate
from wattlake.schemas import TableContract
from wattlake.session import scratch_path
from wattlake.sources import files


#: Partition folders opened one by one; beyond that the table is listed as a whole.
MOST_PATHS = 32


def table_path(root: str, layer: str, table: str) -> str:
    return files.join_path(root, layer, table)


def table_exists(spark: SparkSession, uri: str) -> bool:
    """A folder with data in it; the remains of a failed first write do not count."""
    return bool(files.children(spark, uri))


def read_table(
    spark: SparkSession,
    uri: str,
    contract: TableContract,
    partitions: Sequence[str] | None = None,
) -> DataFrame:
    """A table, or the named partition folders of it, without listing the others.

    The contract's schema is given, so partition strings such as '01' stay strings.
    """
    reader = spark.read.schema(contract.schema)
    if partitions is None:
        return reader.parquet(uri)
    if not partitions:
        return spark.createDataFrame([], contract.schema)
    if len(partitions) > MOST_PATHS:
        # opening a path takes a step of the driver each; a filter over partition columns
        # prunes the listing of the whole table, which Spark makes in parallel
        levels = (F.concat(F.lit(f"{c}="), F.col(c)) for c in contract.partition_by)
        return reader.parquet(uri).filter(F.concat_ws("/", *levels).isin(list(partitions)))
    paths = [files.join_path(uri, folder) for folder in partitions]
    return reader.option("basePath", uri).parquet(*paths)


def partition_folders(spark: SparkSession, uri: str, contract: TableContract) -> list[str]:
    """Relative folders of all partitions, such as ``year=2026/month=01/day=31``."""
    folders = [""]
    for _ in contract.partition_by:
        folders = [
            f"{folder}/{child}".lstrip("/")
            for folder in folders
            for child in files.children(spark, files.join_path(uri, folder))
        ]
    return folders


def touched_folders(df: DataFrame, contract: TableContract) -> list[str]:
    """Relative folders of the partitions that the rows of ``df`` belong to."""
    values = df.select(*contract.partition_by).distinct().collect()
    return sorted(
        "/".join(f"{c}={v}" for c, v in zip(contract.partition_by, row, strict=True)) for row in values
    )


def existing_folders(spark: SparkSession, uri: str, folders: Sequence[str]) -> list[str]:
    """Those of the folders the table has, listing each parent folder once."""
    found: dict[str, set[str]] = {}
    for parent in {folder.rpartition("/")[0] for folder in folders}:
        found[parent] = set(files.children(spark, files.join_path(uri, parent)))
    return [f for f in folders if f.rpartition("/")[2] in found[f.rpartition("/")[0]]]


_MIN_PARTITION = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
#: What the first of the running writes found set, and an entry for each further one.
_spreading: list[str | None] = []
_spreading_lock = threading.Lock()


@contextmanager
def _spread_small_writes(spark: SparkSession) -> Iterator[None]:
    """Let a small write keep its tasks.

    Adaptive execution merges shuffle partitions below 1 MB, so a little data for thousands of
    table partitions would be written by one task, one file after the other.  Writes running at
    the same time share the setting, and the last one to end restores it.
    """
    with _spreading_lock:
        if not _spreading:
            _spreading.append(spark.conf.get(_MIN_PARTITION, None))
            spark.conf.set(_MIN_PARTITION, "16k")
        else:
            _spreading.append(None)
    try:
        yield
    finally:
        with _spreading_lock:
            if len(_spreading) > 1:
                _spreading.pop()
            else:
                before = _spreading.pop()
                if before is None:
                    spark.conf.unset(_MIN_PARTITION)
                else:
                    spark.conf.set(_MIN_PARTITION, before)


def _publish(df: DataFrame, uri: str, contract: TableContract) -> None:
    """Replace exactly the partitions present in ``df``.

    The rebalance gathers a partition's rows so it gets few files, and splits a partition too
    large for one task; rows are sorted inside each file so readers can skip row groups.
    """
    partitions = contract.partition_by
    with _spread_small_writes(df.sparkSession):
        (
            df.hint("rebalance", *partitions)
            .sortWithinPartitions(*partitions, *contract.key)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*partitions)
            .parquet(uri)
        )


def create_table(df: DataFrame, uri: str, contract: TableContract) -> None:
    """First write of a table; an existing table is an error."""
    if table_exists(df.sparkSession, uri):
        raise FileExistsError(f"table already exists: {uri}")
    replace_table(df, uri, contract)


class InterruptedMerge(RuntimeError):
    """A merge of an earlier version, whose rows were not kept, stopped while publishing and stored
    rows are gone; rebuild the table."""


def merge_note(uri: str) -> str:
    return files.join_path(uri, "_merging")


def _merge_folder(uri: str) -> str:
    return f"{uri.rstrip('/')}__merge_"


def finish_merge(spark: SparkSession, uri: str, contract: TableContract) -> bool:
    """Publish what an interrupted merge had staged; whether there was any.

    The note lists nothing but the place of the merged rows.  Folders still there have not been
    moved, or were only removed from the table, so moving them again completes the merge however far
    it had come.
    """
    text = files.read_text(spark, merge_note(uri))
    if not text:
        return False
    if not text.startswith("{"):
        # a note of folders alone: what is lost cannot be published again
        lost = sorted(set(text.splitlines()) - set(existing_folders(spark, uri, text.splitlines())))
        if lost:
            raise InterruptedMerge(f"{uri} lost {', '.join(lost)}; rebuild it from Bronze")
        return False
    note = json.loads(text)
    for folder in partition_folders(spark, note["staged"], contract):
        target = files.join_path(uri, folder)
        files.delete(spark, target)
        files.move(spark, files.join_path(note["staged"], folder), target)
    if note["batch"]:
        _write_batch(spark, uri, *note["batch"])
    files.delete(spark, merge_note(uri))
    files.delete(spark, note["staged"])
    return True


def last_batch(spark: SparkSession, uri: str, writer: str) -> int | None:
    """The number of the last batch that a numbering writer has published into the table."""
    text = files.read_text(spark, files.join_path(uri, "_batches", writer))
    return int(text) if text else None


def _write_batch(spark: SparkSession, uri: str, writer: str, number: int) -> None:
    files.write_text(spark, files.join_path(uri, "_batches", writer), str(number))


def _remove_leftovers(spark: SparkSession, uri: str) -> None:
    """Drop rows staged by merges that stopped before they had a note."""
    parent, _, prefix = _merge_folder(uri).rpartition("/")
    for name in files.children(spark, parent):
        if name.startswith(prefix):
            files.delete(spark, files.join_path(parent, name))


def upsert(
    df: DataFrame,
    uri: str,
    contract: TableContract,
    newer_only: bool = False,
    batch: tuple[str, int] | None = None,
) -> bool:
    """Insert new keys and replace the rows of known keys; ``df`` has each key once.

    The frame is written once to the shared scratch folder, in plain files, which validates it
    and gives Spark its real size for the join.  Only the partitions it touches are read; what
    they become is written next to the table, noted, and moved into it.

    By default the batch always wins.  With ``newer_only`` a stored row with a later
    ``ingested_at`` is kept, which makes the result independent of arrival order.

    ``batch`` is a writer's name and the rising number of its batch.  The number is stored with
    what the batch publishes, and a batch that is already in the table is skipped: False.
    """
    spark = df.sparkSession
    finish_merge(spark, uri, contract)
    if batch:
        last = last_batch(spark, uri, batch[0])
        if last is not None and batch[1] <= last:
            return False
    if not table_exists(spark, uri):
        # written aside and moved once, so that a lost driver leaves all of it or nothing
        replace_table(df, uri, contract)
        if batch:
            _write_batch(spark, uri, *batch)
        return True
    stage_merge(df, uri, contract, newer_only, batch)
    finish_merge(spark, uri, contract)
    return True


def stage_merge(
    df: DataFrame,
    uri: str,
    contract: TableContract,
    newer_only: bool = False,
    batch: tuple[str, int] | None = None,
) -> None:
    """The part of :func:`upsert` before anything in the table changes: what the touched partitions
    become is written next to it, and the note says so.  From there on the merge will be completed."""
    spark = df.sparkSession
    _remove_leftovers(spark, uri)
    checked = guard(conform(df, contract), contract)
    staged_uri = scratch_path(spark, f"{contract.name}-batch")
    try:
        checked.write.parquet(staged_uri)
        rows = read_table(spark, staged_uri, contract)
        touched = touched_folders(rows, contract)
        if touched:
            known = existing_folders(spark, uri, touched)
            if known:
                rows = merged(read_table(spark, uri, contract, known), rows, contract, newer_only)
            place = f"{_merge_folder(uri)}{uuid.uuid4().hex}"
            _publish(rows, place, contract)
            files.write_text(spark, merge_note(uri), json.dumps({"staged": place, "batch": batch}))
        elif batch:
            _write_batch(spark, uri, *batch)
    finally:
        files.delete(spark, staged_uri)


@contextmanager
def staged(df: DataFrame, purpose: str) -> Iterator[DataFrame]:
    """The frame computed once into the shared folder, for use by several jobs.

    Unlike cached blocks, the files outlive the executors that wrote them.
    """
    spark = df.sparkSession
    uri = scratch_path(spark, purpose)
    try:
        df.write.parquet(uri)
        yield spark.read.schema(df.schema).parquet(uri)
    finally:
        files.delete(spark, uri)


def merged(
    stored: DataFrame, batch: DataFrame, contract: TableContract, newer_only: bool = False
) -> DataFrame:
    """Stored rows without those the batch replaces, plus the batch; null keys match nothing."""
    if not newer_only:
        return stored.join(batch, list(contract.key), "left_anti").unionByName(batch)
    both = stored.withColumn("_arrival", F.lit(0)).unionByName(
        batch.withColumn("_arrival", F.lit(1))
    )
    return deduplicate(both, contract.key, tie_break=["_arrival"]).drop("_arrival")


def replace_table(df: DataFrame, uri: str, contract: TableContract) -> None:
    """Replace the whole table, stale partitions included.

    The new table is written next to the old one and moved into its place, so a failed job
    keeps the old table, and ``df`` may read the table it replaces.
    """
    spark = df.sparkSession
    tag = uuid.uuid4().hex
    fresh, retired = f"{uri.rstrip('/')}__new_{tag}", f"{uri.rstrip('/')}__old_{tag}"
    try:
        _publish(guard(conform(df, contract), contract), fresh, contract)
        swap(spark, fresh, uri, retired)
    finally:
        files.delete(spark, fresh)


def swap(spark: SparkSession, fresh: str, uri: str, retired: str) -> None:
    had_table = files.exists(spark, uri)
    if had_table:
        files.move(spark, uri, retired)
    try:
        files.move(spark, fresh, uri)
    except Exception:
        if had_table:
            files.move(spark, retired, uri)
        raise
    if had_table:
        files.delete(spark, retired)


def merge_into_catalog(df: DataFrame, table: str, contract: TableContract) -> None:
    """The upsert on a catalog table whose format supports MERGE (such as Delta or Iceberg)."""
    batch = guard(conform(df, contract), contract).alias("s")
    same_key = reduce(
        lambda left, right: left & right,
        (F.col(f"{table}.{column}") == F.col(f"s.{column}") for column in contract.key),
    )
    batch.mergeInto(table, same_key).whenMatched().updateAll().whenNotMatched().insertAll().merge()

"""High-water mark per Silver table: the stamp of the newest Bronze file loaded into it."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from wattlake.functions.times import format_iso, utc
from wattlake.schemas import TableContract
from wattlake.sources import files
from wattlake.sources.tables import (
    InterruptedMerge,
    finish_merge,
    merge_note,
    read_table,
    table_exists,
    table_path,
)


def mark_path(lake: str, table: str) -> str:
    return files.join_path(lake, "_state", f"watermark_silver_{table}.json")


def read_mark(spark: SparkSession, lake: str, contract: TableContract) -> datetime | None:
    """The stored mark; without one, the newest ``ingested_at`` in the table; else None.

    The table says nothing about what is loaded while a merge into it has not ended, so such a
    merge is ended first; one whose rows were not kept is refused.
    """
    text = files.read_text(spark, mark_path(lake, contract.name))
    if text:
        return utc(datetime.fromisoformat(json.loads(text)["ingested_at"]))
    uri = table_path(lake, "silver", contract.name)
    if not table_exists(spark, uri):
        return None
    if files.exists(spark, merge_note(uri)) and not finish_merge(spark, uri, contract):
        raise InterruptedMerge(f"{uri} has an unfinished merge and no mark; rebuild it from Bronze")
    newest = (
        read_table(spark, uri, contract)
        .agg(format_iso(F.max("ingested_at")).alias("newest"))
        .first()["newest"]
    )
    return datetime.fromisoformat(newest) if newest else None


def keep_mark(spark: SparkSession, lake: str, contract: TableContract) -> datetime | None:
    """The mark, stored if it was derived: once a merge has begun it can no longer be derived."""
    mark = read_mark(spark, lake, contract)
    if mark and not files.exists(spark, mark_path(lake, contract.name)):
        write_mark(spark, lake, contract.name, mark)
    return mark


def write_mark(spark: SparkSession, lake: str, table: str, mark: datetime) -> None:
    text = json.dumps({"ingested_at": utc(mark).isoformat()})
    files.write_text(spark, mark_path(lake, table), text)

"""Ledger of loads: which Bronze files have gone into a Silver table, load by load.

A high-water mark says up to where files were loaded, not which: a file that arrives with a stamp
below the mark is passed over.  The ledger names the files, so that those can be found and loaded.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.sources import bronze, files

COLUMNS = "file string, stamp timestamp"


class NoLedger(RuntimeError):
    """Files were loaded before a ledger was kept; a rebuild starts one."""


def ledger_path(lake: str, table: str) -> str:
    return files.join_path(lake, "_state", f"ledger_silver_{table}")


def record_load(spark: SparkSession, lake: str, table: str, listing: DataFrame, load: str) -> None:
    """Store the files of a load under its name; the same load repeated replaces its entry."""
    entry = files.join_path(ledger_path(lake, table), f"load={load}")
    listing.select("file", "stamp").write.mode("overwrite").parquet(entry)


def forget_loads(spark: SparkSession, lake: str, table: str) -> None:
    files.delete(spark, ledger_path(lake, table))


def read_ledger(spark: SparkSession, lake: str, table: str) -> DataFrame:
    """(file, stamp, load) of everything loaded; a file in two loads is there twice."""
    return spark.read.schema(f"{COLUMNS}, load string").parquet(ledger_path(lake, table))


def late_files(
    spark: SparkSession, lake: str, table: str, root: str, mark: datetime | None, layout: str = "files"
) -> DataFrame:
    """(file, stamp) of the files at or below the mark that no load has taken.

    The listing and the ledger are compared by Spark; neither comes to the driver.
    """
    if mark is None:
        return spark.createDataFrame([], COLUMNS)
    if not files.children(spark, ledger_path(lake, table)):
        raise NoLedger(f"no ledger of the loads into {table}; rebuild it from Bronze")
    listed = bronze.listing(spark, root, upto=mark, layout=layout)
    return listed.join(read_ledger(spark, lake, table).select("file"), "file", "left_anti")

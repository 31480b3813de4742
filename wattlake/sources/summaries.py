"""Day summaries of a Silver table, kept next to it and renewed where its files have changed.

A summary row says what the checks need to know of a partition (see
:func:`wattlake.operators.quality.day_summary`), and carries a fingerprint of the partition's files: their
names, sizes and times of change.  A partition whose files are not those of its summary is read again,
whoever wrote them, and all others are not.  So the checks of a large table after a small merge read what
the merge has touched, and a summary that a lost driver did not write is simply renewed by the next run.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattlake.operators.quality import day_summary
from wattlake.schemas import TableContract
from wattlake.sources import files
from wattlake.sources.tables import read_table, swap, table_path

_MEASURES = """fingerprint string, in_hour bigint, rows bigint, duplicates bigint, hours bigint,
    first_time timestamp, last_time timestamp"""


def summary_path(lake: str, table: str) -> str:
    return files.join_path(lake, "_state", f"summary_silver_{table}")


def summary_schema(contract: TableContract) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in contract.partition_by] + list(
        T.StructType.fromDDL(_MEASURES)
    ))


def fingerprints(spark: SparkSession, uri: str, contract: TableContract) -> DataFrame:
    """(partition columns, fingerprint) of a table's partitions, from the listing of its files alone."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(uri)
    name = F.substring_index("path", "/", -1)
    parts = [
        F.regexp_extract("path", f"/{c}=([^/]+)/", 1).alias(c) for c in contract.partition_by
    ]
    one = F.xxhash64(name, "length", "modificationTime")
    marks = [F.count(F.lit(1)), F.sum("length"), F.expr("bit_xor(_file)")]
    return (
        listed.select(*parts, "length", one.alias("_file"))
        .groupBy(*contract.partition_by)
        .agg(F.concat_ws("-", *(m.cast("string") for m in marks)).alias("fingerprint"))
    )


def refresh_summary(
    spark: SparkSession, lake: str, contract: TableContract, time_col: str = "datetime_utc"
) -> tuple[DataFrame, int]:
    """The up-to-date summary of a Silver table, and the number of partitions read for it.

    The driver handles the names of changed partitions; the summary itself, a row per partition and
    position in the hour, is compared, renewed and written by Spark.
    """
    uri, kept_uri = table_path(lake, "silver", contract.name), summary_path(lake, contract.name)
    schema, columns = summary_schema(contract), list(contract.partition_by)
    known = files.children(spark, kept_uri)
    stored = spark.read.schema(schema).parquet(kept_uri) if known else spark.createDataFrame([], schema)
    # listed once, so that what is compared and what is stored are the same state
    state = fingerprints(spark, uri, contract)
    now = spark.createDataFrame([tuple(row) for row in state.collect()], schema[: len(columns) + 1])
    seen = stored.select(*columns, "fingerprint").distinct()
    changed = now.join(seen, [*columns, "fingerprint"], "left_anti")
    folders = sorted("/".join(f"{c}={row[c]}" for c in columns) for row in changed.collect())
    gone = seen.join(now, [*columns, "fingerprint"], "left_anti")
    if known and not folders and gone.isEmpty():
        return stored, 0
    everything = len(folders) == now.count()
    rows = read_table(spark, uri, contract, None if everything else folders)
    fresh = day_summary(rows, contract.key, columns, time_col).join(changed, columns)
    kept = stored.join(now, [*columns, "fingerprint"], "left_semi")
    tag = uuid.uuid4().hex
    place, retired = f"{kept_uri}__new_{tag}", f"{kept_uri}__old_{tag}"
    try:
        kept.select(*schema.names).unionByName(fresh.select(*schema.names)).write.parquet(place)
        swap(spark, place, kept_uri, retired)
    finally:
        files.delete(spark, place)
    return spark.read.schema(schema).parquet(kept_uri), len(folders)

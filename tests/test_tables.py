from datetime import timedelta
from pathlib import Path

import pytest
from samples import documents, mix_document, moment
from pyspark.sql import functions as F

from wattlake.operators.flatten import add_partition_columns, flatten_mix
from wattlake.schemas import DAILY_IMPORTS, MIX
from wattlake.sources import files
from wattlake.sources.tables import (
    InterruptedMerge,
    create_table,
    existing_folders,
    merge_into_catalog,
    partition_folders,
    read_table,
    replace_table,
    table_exists,
    upsert,
)


def rows(spark, **change):
    return add_partition_columns(flatten_mix(documents(spark, mix_document(**change))))


@pytest.fixture
def uri(lake):
    return lake + "/silver/electricity_mix"


def nuclear(spark, uri):
    df = read_table(spark, uri, MIX).filter("source = 'nuclear' AND hour(datetime_utc) = 0")
    return [r["power_mw"] for r in df.collect()]


def test_upsert_is_idempotent_and_updates_values(spark, uri):
    upsert(rows(spark), uri, MIX)
    upsert(rows(spark), uri, MIX)
    table = read_table(spark, uri, MIX)
    assert table.count() == 12 and table.schema == MIX.schema
    upsert(rows(spark, nuclear=12345.0, ingested_at="2026-10-03T21:30:00+00:00"), uri, MIX)
    assert read_table(spark, uri, MIX).count() == 12
    assert nuclear(spark, uri) == [12345.0]


def test_the_batch_wins_unless_only_newer_rows_may(spark, uri):
    upsert(rows(spark), uri, MIX)
    older = rows(spark, nuclear=1.0, ingested_at="2026-10-01T00:00:00+00:00")
    upsert(older, uri, MIX, newer_only=True)
    assert nuclear(spark, uri) == [300.0]
    same_time = rows(spark, nuclear=2.0)
    upsert(same_time, uri, MIX, newer_only=True)
    assert nuclear(spark, uri) == [2.0]
    upsert(older, uri, MIX)
    assert nuclear(spark, uri) == [1.0]


@pytest.mark.parametrize("existing", [False, True])
def test_a_broken_rule_rejects_the_whole_write(spark, uri, existing):
    if existing:
        upsert(rows(spark), uri, MIX)
    with pytest.raises(Exception, match="failed validation check"):
        upsert(rows(spark, nuclear=-1.0), uri, MIX)
    assert table_exists(spark, uri) is existing
    upsert(rows(spark), uri, MIX)
    assert nuclear(spark, uri) == [300.0]


def test_only_touched_partitions_are_rewritten(spark, uri, lake):
    days = spark.range(4).select(F.expr("timestampadd(DAY, id, timestamp'2026-01-30')").alias("d"))
    base = rows(spark).drop("datetime_utc", "year", "month", "day")
    spread = add_partition_columns(
        base.crossJoin(days).withColumnRenamed("d", "datetime_utc").distinct()
    ).dropDuplicates(list(MIX.key))
    upsert(spread, uri, MIX)

    def stored():
        return {r["f"]: r["n"] for r in read_table(spark, uri, MIX).groupBy(
            F.col("_metadata.file_path").alias("f")).agg(F.count("*").alias("n")).collect()}

    before = stored()
    change = spread.filter("day = '31'").withColumn("power_mw", F.lit(7.0))
    upsert(change, uri, MIX)
    after = stored()
    kept = set(before) & set(after)
    assert {f.split("/day=")[1][:2] for f in set(after) - kept} == {"31"}
    assert {f.split("/day=")[1][:2] for f in kept} == {"30", "01", "02"}
    assert sum(after.values()) == sum(before.values())
    months = {r["month"] for r in read_table(spark, uri, MIX).select("month").collect()}
    assert months == {"01", "02"}


def test_a_table_is_created_once(spark, uri):
    create_table(rows(spark), uri, MIX)
    with pytest.raises(FileExistsError):
        create_table(rows(spark), uri, MIX)


def exchange(spark, *entries):
    data = [
        (moment(d).date(), moment(d), moment(d) + timedelta(days=1), 24, "ES", "Spain", "ES",
         "FR", "France", "FR", net, d[:4])
        for d, net in entries
    ]
    return spark.createDataFrame(data, DAILY_IMPORTS.schema)


def test_replacing_drops_stale_partitions_and_may_read_itself(spark, uri):
    first = exchange(spark, ("2024-05-01 00:00:00", 1.0), ("2025-05-01 00:00:00", 2.0))
    replace_table(first, uri, DAILY_IMPORTS)
    stored = read_table(spark, uri, DAILY_IMPORTS)
    replace_table(stored.filter("year = '2025'"), uri, DAILY_IMPORTS)
    assert files.children(spark, uri) == ["year=2025"]
    assert [r["net_mwh"] for r in read_table(spark, uri, DAILY_IMPORTS).collect()] == [2.0]


def test_a_failed_replacement_keeps_the_old_table(spark, uri, lake):
    replace_table(exchange(spark, ("2024-05-01 00:00:00", 1.0)), uri, DAILY_IMPORTS)
    bad = exchange(spark, ("2024-05-01 00:00:00", 3.0), ("2025-05-01 00:00:00", 0.0))
    with pytest.raises(Exception, match="net_positive"):
        replace_table(bad, uri, DAILY_IMPORTS)
    assert [r["net_mwh"] for r in read_table(spark, uri, DAILY_IMPORTS).collect()] == [1.0]
    assert files.children(spark, lake + "/silver") == ["electricity_mix"]


def test_a_hot_day_is_split_over_files(spark, uri):
    """A partition with a third of all rows must not be written by a single task."""
    width = 200_000
    df = spark.range(0, width, 1, 8).select(
        F.concat(F.lit("Z"), F.col("id").cast("string")).alias("zone"),
        F.when(F.col("id") % 3 == 0, F.expr("timestamp'2026-01-01'")).otherwise(
            F.expr("timestampadd(DAY, id % 40, timestamp'2026-02-01')")
        ).alias("datetime_utc"),
        F.lit("gas").alias("source"), F.rand(1).alias("power_mw"),
        F.lit(None).cast("string").alias("estimation_method"), F.lit(False).alias("is_estimated"),
        F.expr("timestamp'2026-03-01'").alias("updated_at"),
        F.expr("timestamp'2026-03-01'").alias("ingested_at"),
    )
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "256k")
    try:
        upsert(add_partition_columns(df), uri, MIX)
    finally:
        spark.conf.unset(key)
    table = read_table(spark, uri, MIX)
    assert table.count() == width
    names = table.filter("month = '01'").select("_metadata.file_path").distinct().count()
    assert names > 1


def test_catalog_merge_needs_a_table_that_supports_it(spark):
    rows(spark).write.saveAsTable("plain_mix")
    try:
        with pytest.raises(Exception, match="UNSUPPORTED_FEATURE|MERGE"):
            merge_into_catalog(rows(spark), "plain_mix", MIX)
    finally:
        spark.sql("DROP TABLE plain_mix")


def test_partitions_are_found_without_listing_the_table(spark, uri):
    assert partition_folders(spark, uri, MIX) == []
    upsert(rows(spark), uri, MIX)
    assert partition_folders(spark, uri, MIX) == ["year=2026/month=10/day=02"]
    wanted = ["year=2026/month=10/day=02", "year=2026/month=10/day=03", "year=2027/month=01/day=01"]
    assert existing_folders(spark, uri, wanted) == wanted[:1]
    assert read_table(spark, uri, MIX, wanted[:1]).count() == 12
    assert read_table(spark, uri, MIX, []).schema == MIX.schema


def test_an_empty_batch_changes_nothing(spark, uri):
    upsert(rows(spark), uri, MIX)
    upsert(rows(spark).limit(0), uri, MIX)
    assert read_table(spark, uri, MIX).count() == 12


def test_an_interrupted_merge_is_completed_or_refused(spark, uri):
    upsert(rows(spark), uri, MIX)
    note = Path(uri, "_merging")
    note.write_text("year=2026/month=10/day=02")
    upsert(rows(spark, nuclear=5.0), uri, MIX)  # nothing was lost: merged again
    assert nuclear(spark, uri) == [5.0] and not note.exists()
    note.write_text("year=2026/month=10/day=02\nyear=2026/month=10/day=01")
    with pytest.raises(InterruptedMerge, match="lost year=2026/month=10/day=01"):
        upsert(rows(spark), uri, MIX)
    assert nuclear(spark, uri) == [5.0]
    replace_table(rows(spark), uri, MIX)
    upsert(rows(spark, nuclear=6.0), uri, MIX)
    assert nuclear(spark, uri) == [6.0]

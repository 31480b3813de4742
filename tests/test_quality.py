import random
import re
from datetime import timedelta

from samples import moment
from pyspark.sql import functions as F

from wattlake.operators.quality import (
    first_missing,
    key_counts,
    missing_hours,
    no_missing_hours,
    unique_key,
)

T0 = moment("2026-10-02 00:00:00")


def hours(spark, *numbers):
    rows = [(T0 + timedelta(hours=n),) for n in numbers]
    return spark.createDataFrame(rows, "datetime_utc timestamp")


def test_gaps_are_found(spark):
    assert no_missing_hours(hours(spark, 0, 1, 2)).passed
    result = no_missing_hours(hours(spark, 0, 2, 2, 9))
    assert not result.passed
    assert result.description.startswith("7 missing hours: ['2026-10-02 01:00:00'")
    assert result.description.count("2026") == 5


def test_an_empty_table_has_no_gaps(spark):
    assert no_missing_hours(hours(spark)).passed


def test_the_overall_grid_ignores_series_but_by_series_does_not(spark):
    rows = [("a", T0), ("a", T0 + timedelta(hours=2)), ("b", T0 + timedelta(hours=1))]
    df = spark.createDataFrame(rows, "zone string, datetime_utc timestamp")
    assert no_missing_hours(df).passed
    found = missing_hours(df, by=["zone"]).collect()
    assert [(r["zone"], r["datetime_utc"].hour) for r in found] == [("a", 1)]


def test_times_off_the_grid_do_not_fill_it(spark):
    df = hours(spark, 0, 2).unionByName(hours(spark, 1.5))
    assert [r["datetime_utc"].hour for r in missing_hours(df).collect()] == [1]


def scans(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("FileScan") + plan.count("Scan ExistingRDD")


def test_gaps_are_found_in_one_pass(spark, tmp_path):
    hours(spark, 0, 30, 80).write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert scans(missing_hours(stored)) == 1
    assert missing_hours(stored).count() == 78


def test_times_off_the_grid_are_left_out_before_one_task_gets_the_rest(spark):
    df = hours(spark, 0, 30).unionByName(hours(spark, *(n / 97 for n in range(1, 500))))
    missing = missing_hours(df)
    assert missing.count() == 24
    plan = missing._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Filter .*__in_hour", plan[plan.index("SinglePartition"):])


def test_the_grid_starts_at_the_first_time_and_ends_before_the_last(spark):
    found = missing_hours(hours(spark, 0.25, 1, 3.25, 5).withColumn("x", F.lit(None).cast("string")), by=["x"])
    assert sorted(r["datetime_utc"].strftime("%H:%M") for r in found.collect()) == ["01:15", "02:15", "04:15"]
    assert found.filter("x IS NULL").count() == 3
    assert missing_hours(hours(spark, 5).unionByName(spark.sql("SELECT CAST(NULL AS TIMESTAMP) AS datetime_utc"))).count() == 0


def test_random_gaps_against_plain_python(spark):
    rng = random.Random(11)
    present = {z: {rng.randrange(200) for _ in range(120)} for z in "abc"}
    rows = [(z, T0 + timedelta(hours=h)) for z, hs in present.items() for h in hs for _ in (1, 2)]
    df = spark.createDataFrame(rows, "zone string, datetime_utc timestamp")
    expected = {
        (z, T0 + timedelta(hours=h)) for z, hs in present.items()
        for h in range(min(hs), max(hs)) if h not in hs
    }
    missing = missing_hours(df, by=["zone"])
    found = {(r["zone"], r["datetime_utc"].replace(tzinfo=T0.tzinfo)) for r in missing.collect()}
    assert found == expected
    first = [(r["datetime_utc"].replace(tzinfo=T0.tzinfo), r["zone"])
             for r in first_missing(missing, by=["zone"]).collect()]
    assert first == sorted((t, z) for z, t in expected)[:5]


def test_duplicate_keys_are_counted_with_null_as_a_value(spark):
    rows = [("a", 1), ("a", 1), ("a", 1), (None, 1), (None, 1), ("b", None), ("b", 2)]
    df = spark.createDataFrame(rows, "x string, y int")
    result = unique_key(df, ["x", "y"])
    assert not result.passed and result.description.startswith("3 duplicate rows on key")
    assert unique_key(df.filter("x = 'b'"), ["x", "y"]).passed
    assert unique_key(df.limit(0), ["x", "y"]).passed


def test_a_hot_key_is_counted_before_the_shuffle(spark):
    df = spark.range(0, 9000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("key")
    )
    assert [r["duplicates"] for r in key_counts(df, ["key"]).collect()] == [2999]
    plan = key_counts(df, ["key"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan[plan.index("Exchange"):]

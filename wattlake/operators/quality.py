"""Checks that span several rows.

Operators returning DataFrames find the rows; ``unique_key``, ``no_missing_hours`` and
``percentages_sum_to_100`` run them and bring only counts and a few sample hours to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattlake.functions.values import total
from wattlake.session import scratch_path


@dataclass(frozen=True)
class CheckResult:
    passed: bool
    description: str
    failures: int = 0


def key_counts(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with the number of surplus rows; null counts as a value."""
    return (
        df.groupBy(*key)
        .agg((F.count(F.lit(1)) - 1).alias("duplicates"))
        .filter(F.col("duplicates") > 0)
    )


def duplicate_rows(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: rows beyond the first of every key."""
    return key_counts(df, key).agg(
        F.coalesce(F.sum("duplicates"), F.lit(0)).alias("duplicates")
    )


def unique_key(df: DataFrame, key: Sequence[str]) -> CheckResult:
    return _unique(duplicate_rows(df, key), key)


def _unique(counted: DataFrame, key: Sequence[str]) -> CheckResult:
    duplicates = counted.first()["duplicates"]
    description = f"{duplicates} duplicate rows on key {list(key)}"
    return CheckResult(duplicates == 0, description, duplicates)


def missing_hours(
    df: DataFrame, time_col: str = "datetime_utc", by: Sequence[str] = ()
) -> DataFrame:
    """Hours between the first and the last one that no row has, overall or per series.

    Times are first combined to one row per series, day and position in the hour, the hours of
    the day being bits.  A series counts from its own first time on, so only the rows with that
    position matter; its missing hours are the bits not set, and the days between two rows.
    One pass over the table; what is brought together per series are its days, and hours are
    written out day by day.  Overall, the combined rows are written to the shared folder and their
    bounds taken when this is called, so that only calendar days with the first time's position
    are brought together, however many times lie at other positions.
    """
    kind = df.schema[time_col].dataType
    df = df.withColumn(time_col, F.col(time_col).cast("timestamp"))
    time, day = F.col(time_col), F.date_trunc("day", time_col)
    days = (
        df.filter(time.isNotNull())
        .groupBy(*by, day.alias("__day"), in_hour(time).alias("__in_hour"))
        .agg(hour_bits(time).alias("__hours"), F.min(time).alias("__first"), F.max(time).alias("__last"))
    )
    return _hours_between(days, time_col, kind, by)


def in_hour(time: Column) -> Column:
    """Microseconds since the full hour."""
    return F.unix_micros(time) - F.unix_micros(F.date_trunc("hour", time))


def hour_bits(time: Column) -> Column:
    """Aggregate: the hours of a day that occur, as bits."""
    return F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.hour(time)))


def _hours_between(
    days: DataFrame, time_col: str, kind: T.DataType, by: Sequence[str] = ()
) -> DataFrame:
    """Missing hours of a table combined to (by, __day, __in_hour, __hours, __first, __last)."""
    series = Window.partitionBy(*by)
    following = F.lead("__day").over(series.orderBy("__day"))
    day_step = F.expr("INTERVAL 1 DAY")
    if by:
        bounded = days.withColumns({
            "__from": F.min("__first").over(series), "__upto": F.max("__last").over(series),
        })
    else:
        path = scratch_path(days.sparkSession, "hours-of-days")
        days.write.parquet(path)
        days = days.sparkSession.read.schema(days.schema).parquet(path)
        # as numbers, which no time zone of the driver changes
        bounds = days.agg(F.unix_micros(F.min("__first")), F.unix_micros(F.max("__last"))).first()
        first, last = (F.timestamp_micros(F.lit(b).cast("long")) for b in bounds)
        bounded = days.withColumns({"__from": first, "__upto": last})
    on_grid = (
        bounded.filter(F.col("__in_hour") == F.unix_micros("__from") - F.unix_micros(F.date_trunc("hour", "__from")))
    )
    # every day up to the next row's, or up to the last time of the series
    until = F.coalesce(following - day_step, F.date_trunc("day", "__upto"))
    each_day = on_grid.withColumn("__until", until).select(
        *by, "__in_hour", "__from", "__upto", "__hours", F.col("__day").alias("__seen"),
        F.explode(F.sequence("__day", "__until", day_step)).alias("__day"),
    )
    hours = F.when(F.col("__day") == F.col("__seen"), F.col("__hours")).otherwise(F.lit(0).cast("long"))
    unset = F.filter(
        F.sequence(F.lit(0), F.lit(23)),
        lambda h: F.call_function("getbit", F.col("__hours"), h) == 0,
    )
    start = F.unix_micros("__day") + F.col("__in_hour")
    return (
        each_day.withColumn("__hours", hours)
        .filter(F.bit_count("__hours") < 24)
        .select(*by, "__from", "__upto", start.alias("__start"), F.explode(unset).alias("__hour"))
        .withColumn(time_col, F.timestamp_micros(F.col("__start") + F.col("__hour") * 3_600_000_000))
        .filter(F.col(time_col).between(F.col("__from"), F.col("__upto")))
        .select(*by, F.col(time_col).cast(kind).alias(time_col))
    )


def first_missing(
    missing: DataFrame, time_col: str = "datetime_utc", by: Sequence[str] = (), n: int = 5
) -> DataFrame:
    return missing.orderBy(time_col, *by).limit(n)


def no_missing_hours(df: DataFrame, time_col: str = "datetime_utc") -> CheckResult:
    """Every hour between the table's first and last hour is in it, whatever the series."""
    return _no_missing(missing_hours(df, time_col), time_col)


def _no_missing(missing: DataFrame, time_col: str) -> CheckResult:
    count = missing.count()
    sample = [str(row[time_col]) for row in first_missing(missing, time_col).collect()] if count else []
    return CheckResult(count == 0, f"{count} missing hours: {sample}", count)


def day_summary(df: DataFrame, key: Sequence[str], by: Sequence[str], time_col: str = "datetime_utc") -> DataFrame:
    """What the checks of a table need to know of each group of its rows, in one pass.

    Per group ``by`` and position in the hour: rows, rows beyond the first of their key, the hours
    as bits, first and last time.  Where a key lies within one group, as one with the time in it does
    in a table partitioned by day, summaries of different groups add up to that of the table.
    """
    time = F.col(time_col)
    keys = df.groupBy(*by, *(c for c in dict.fromkeys([*key, time_col]) if c not in by)).agg(
        F.count(F.lit(1)).alias("__n")
    )
    return keys.groupBy(*by, in_hour(time).alias("in_hour")).agg(
        F.sum("__n").alias("rows"), F.sum(F.col("__n") - 1).alias("duplicates"),
        hour_bits(time).alias("hours"), F.min(time).alias("first_time"), F.max(time).alias("last_time"),
    )


def unique_key_of(summary: DataFrame, key: Sequence[str]) -> CheckResult:
    """:func:`unique_key` from day summaries alone."""
    return _unique(summary.agg(F.coalesce(F.sum("duplicates"), F.lit(0)).alias("duplicates")), key)


def missing_hours_of(summary: DataFrame, time_col: str = "datetime_utc") -> DataFrame:
    """:func:`missing_hours` of the whole table from day summaries alone."""
    days = (
        summary.filter(F.col("first_time").isNotNull())
        .groupBy(F.date_trunc("day", "first_time").alias("__day"), F.col("in_hour").alias("__in_hour"))
        .agg(
            F.bit_or("hours").alias("__hours"), F.min("first_time").alias("__first"), F.max("last_time").alias("__last")
        )
    )
    return _hours_between(days, time_col, summary.schema["first_time"].dataType)


def no_missing_hours_of(summary: DataFrame, time_col: str = "datetime_utc") -> CheckResult:
    return _no_missing(missing_hours_of(summary, time_col), time_col)


def percentage_totals(daily_mix: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Zone-days whose percentages do not add up to 100; a day without any adds up to 0."""
    return (
        daily_mix.groupBy("zone", "date_utc")
        .agg(total(F.col("percentage")).alias("total"))
        .filter(F.abs(F.col("total") - 100) > tolerance)
    )


def percentages_sum_to_100(daily_mix: DataFrame) -> CheckResult:
    days = percentage_totals(daily_mix).count()
    return CheckResult(days == 0, f"{days} days where percentages do not sum to 100", days)

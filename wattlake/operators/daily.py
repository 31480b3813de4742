"""Daily products from hourly measurements.

An hourly value is an average power in MW, so the sum over a day is the energy in MWh.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattlake.functions.times import day_of, day_start
from wattlake.functions.values import total
from wattlake.operators.lookup import with_dimension
from wattlake.schemas import DAILY_IMPORTS, DAILY_MIX

# An hour of a day of at most 60 hours gets one of 60 bits; a null timestamp gets the next one.
_BITS = 60


def _hour_bit(time: Column, on_the_hour: Column) -> Column:
    hour = F.pmod(F.floor(F.unix_seconds(time) / 3600), F.lit(_BITS)).cast("int")
    return (
        F.when(time.isNull(), F.lit(1 << _BITS))
        .when(on_the_hour, F.call_function("shiftleft", F.lit(1).cast("long"), hour))
        .otherwise(F.lit(0).cast("long"))
    )


def daily_totals(
    df: DataFrame,
    by: Sequence[str],
    sums: Mapping[str, str],
    time_col: str = "datetime_utc",
    time_zone: str | None = None,
    cluster_by: Sequence[str] = (),
) -> DataFrame:
    """Per group and day: one sum per ``output name -> measure`` and the hours covered.

    A null measure adds 0 but its hour still counts; hours are distinct timestamps, null
    counting as one.  The first aggregation groups by day and, only for timestamps off the
    hour, by the timestamp; those on the hour are collected as bits of one integer.  So map
    tasks combine an hourly table to one row per group and day before anything is shuffled,
    and the count stays exact for any timestamps.

    ``cluster_by`` names columns, a subset of the group and ``date_utc``, that the caller
    partitions a window by: the second aggregation then runs on that partitioning and the
    window needs no shuffle of its own.  It suits tables with few timestamps off the hour;
    without it, those are combined per task before the second shuffle as well.
    """
    time = F.col(time_col)
    on_the_hour = F.date_trunc("hour", time) == time
    by_time = df.groupBy(
        *by,
        day_of(time, time_zone).alias("date_utc"),
        F.when(~on_the_hour, time).alias("off_the_hour"),
    ).agg(
        *(total(F.col(measure)).alias(name) for name, measure in sums.items()),
        F.bit_or(_hour_bit(time, on_the_hour)).alias("hours"),
    )
    if cluster_by:
        by_time = by_time.repartition(*cluster_by)
    hours_covered = F.bit_count(F.bit_or("hours")) + F.count("off_the_hour")
    return by_time.groupBy(*by, "date_utc").agg(
        *(F.sum(name).alias(name) for name in sums),
        hours_covered.cast("int").alias("hours_covered"),
    )


def add_day_columns(df: DataFrame, time_zone: str | None = None) -> DataFrame:
    day = F.col("date_utc")
    return df.withColumns(
        {
            "period_start_utc": day_start(day, time_zone),
            "period_end_utc": day_start(F.date_add(day, 1), time_zone),
            "year": F.date_format(day, "yyyy"),
        }
    )


def with_share(df: DataFrame, value: str, by: Sequence[str], name: str) -> DataFrame:
    """Percentage of the group's total; null unless the total is positive."""
    whole = F.sum(value).over(Window.partitionBy(*by))
    share = F.when(F.col("_whole") > 0, F.col(value) / F.col("_whole") * 100)
    return df.withColumn("_whole", whole).withColumn(name, share).drop("_whole")


def daily_relative_mix(
    mix: DataFrame,
    zones: DataFrame,
    time_zone: str | None = None,
    ordered: bool = True,
    hourly: bool = False,
) -> DataFrame:
    """Share of each source in a zone's daily production; charging storage is not production.

    The window runs on daily rows, so a partition holds one zone-day's sources.  ``hourly``
    only chooses the plan: the default combines timestamps off the hour in map tasks before a
    zone-day meets in one task, whatever their number; True saves that shuffle of daily rows for
    tables known to be hourly.
    """
    zone_day = ["zone", "date_utc"]
    daily = daily_totals(
        mix.filter(~F.col("source").endswith("_charge")),
        ["zone", "source"],
        {"energy_mwh": "power_mw"},
        time_zone=time_zone,
        cluster_by=zone_day if hourly else (),
    )
    shares = with_share(daily, "energy_mwh", zone_day, "percentage")
    product = with_dimension(
        add_day_columns(shares, time_zone), zones, "zone", ["zone_name", "country_code"]
    ).select(*DAILY_MIX.schema.names)
    return product.orderBy(*DAILY_MIX.key) if ordered else product


def daily_net_flows(flows: DataFrame) -> DataFrame:
    """Daily import, export and net import per pair of zones."""
    return daily_totals(
        flows,
        ["zone", "counterpart_zone"],
        {"import_mwh": "import_mw", "export_mwh": "export_mw"},
    ).withColumn("net_import_mwh", F.col("import_mwh") - F.col("export_mwh"))


def exchange_table(
    net_flows: DataFrame, zones: DataFrame, direction: str, ordered: bool = True
) -> DataFrame:
    """Pair-days with a net flow in one direction, as a positive amount from zone to zone.

    A pair-day that nets to exactly 0, or to NaN, is in neither direction.
    """
    here, there = F.col("zone"), F.col("counterpart_zone")
    balance = F.col("net_import_mwh")
    # NaN sorts above all numbers, so it would count as an import
    origin, target, net, flows_so = {
        "import": (there, here, balance, (balance > 0) & ~F.isnan(balance)),
        "export": (here, there, -balance, balance < 0),
    }[direction]
    directed = net_flows.filter(flows_so).select(
        "date_utc",
        "hours_covered",
        origin.alias("from_zone"),
        target.alias("to_zone"),
        net.alias("net_mwh"),
    )
    named = add_day_columns(directed)
    for prefix in ("from_", "to_"):
        named = with_dimension(named, zones, "zone", ["zone_name", "country_code"], prefix)
    product = named.select(*DAILY_IMPORTS.schema.names)
    return product.orderBy(*DAILY_IMPORTS.key) if ordered else product


def daily_imports(flows: DataFrame, zones: DataFrame) -> DataFrame:
    return exchange_table(daily_net_flows(flows), zones, "import")


def daily_exports(flows: DataFrame, zones: DataFrame) -> DataFrame:
    return exchange_table(daily_net_flows(flows), zones, "export")

"""Hourly measurements, pairwise flows and raw documents derived from a sales warehouse.

The supplied tables are orders and events rather than power readings; these adapters give them
the shapes the operators work on.  Every adapter uses all rows of its tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattlake.functions.times import date_parts, format_iso, month_of
from wattlake.operators.dedupe import deduplicate
from wattlake.operators.flatten import is_estimated
from wattlake.schemas import MIX


# Columns of the supplied tables; declared, so no job has to look them up.
_COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": """c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,
                   c_mktsegment string""",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string,
                 o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,
                   l_quantity double, l_extendedprice double, l_discount double, l_tax double,
                   l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz""",
    "events": """event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,
                 value double, props string""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stored table; its zone-less timestamps are UTC instants."""
    df = spark.read.schema(_COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")
    zoneless = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({name: F.col(name).cast("timestamp") for name in zoneless})


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as zones, their region as the country code."""
    region = table(spark, sf_dir, "region")
    return (
        table(spark, sf_dir, "nation")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("n_name").alias("zone"),
            F.col("n_name").alias("zone_name"),
            F.col("r_name").alias("country_code"),
        )
    )


def mix_readings(spark: SparkSession, sf_dir: str, gaps: bool = True) -> DataFrame:
    """Every event as a reading of its user's nation, hour and event type.

    Two event types play a storage's charge and discharge, those of an hour's eighth minute are
    not reported (null) unless ``gaps`` is off, and the value's size decides how it was estimated.  A key occurs more than once.
    """
    value, kind = F.col("value"), F.col("event_type")
    source = (
        F.when(kind == "error", "hydro_storage_charge")
        .when(kind == "purchase", "hydro_storage_discharge")
        .otherwise(kind)
    )
    method = (
        F.when(value < 10, F.lit(None))
        .when(value < 20, "SURROGATE")
        .when(value < 30, "ESTIMATED")
        .otherwise("MEASURED")
    )
    power = F.when(F.minute("ts") != 7, value) if gaps else value
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        table(spark, sf_dir, "events")
        .join(customer, F.col("user_id") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("n_name").alias("zone"),
            F.date_trunc("hour", "ts").alias("datetime_utc"),
            source.alias("source"),
            power.alias("power_mw"),
            method.alias("estimation_method"),
            is_estimated(method).alias("is_estimated"),
            F.col("ts").alias("updated_at"),
            F.col("ts").alias("ingested_at"),
            "event_id",
        )
    )


def delivered_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings as two deliveries per day, the second revising hours of the first.

    Events of an hour's first half are delivered at midnight after their day, those of the
    second half six hours later; each delivery holds the latest reading per key.  Method and
    update time are those of the whole hour, as a document has one of each per entry.
    """
    moment = F.col("updated_at")
    delivered_at = F.date_trunc("day", moment) + F.when(
        F.minute(moment) < 30, F.expr("INTERVAL 24 HOUR")
    ).otherwise(F.expr("INTERVAL 30 HOUR"))
    readings = mix_readings(spark, sf_dir).withColumn("ingested_at", delivered_at)
    return deduplicate(
        readings,
        ["zone", "datetime_utc", "ingested_at", "source"],
        order_by="updated_at",
        tie_break=["event_id"],
    )


def delivered_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver rows of every delivery, with the hour's method and update time."""
    hours = (
        delivered_readings(spark, sf_dir)
        .groupBy("zone", "datetime_utc", "ingested_at")
        .agg(
            F.max("estimation_method").alias("estimation_method"),
            F.max("updated_at").alias("updated_at"),
            F.collect_list(F.struct("source", "power_mw")).alias("sources"),
        )
    )
    return (
        hours.withColumn("reading", F.explode("sources"))
        .select("*", "reading.source", "reading.power_mw")
        .withColumn("is_estimated", is_estimated(F.col("estimation_method")))
        .withColumns(date_parts(F.col("datetime_utc")))
        .select(*MIX.schema.names)
    )


def _number(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit("null"))


def _member(name: Column, json: Column) -> Column:
    return F.concat(F.lit('"'), name, F.lit('":'), json)


def _object(members: Column) -> Column:
    return F.concat(F.lit("{"), F.array_join(members, ","), F.lit("}"))


def _responses(entries: DataFrame, period: Column) -> DataFrame:
    """Raw responses, one per zone, ingestion and period, out of (datetime_utc, entry) rows."""
    history = F.transform(
        F.sort_array(F.collect_list(F.struct("datetime_utc", "entry"))), lambda x: x["entry"]
    )
    response = F.concat(
        F.lit('{"zone":"'), "zone",
        F.lit('","temporalGranularity":"hourly","unit":"MW","history":['),
        F.array_join("history", ","), F.lit("]}"),
    )
    return (
        entries.groupBy("zone", "ingested_at", period.alias("period"))
        .agg(history.alias("history"))
        .select(
            "zone",
            "ingested_at",
            F.concat(F.lit("surrogate://"), "zone").alias("source_url"),
            response.alias("response"),
        )
    )


def mix_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deliveries as raw JSON: one document per zone and delivered day.

    Storage becomes a nested object under a name with a space (empty when the hour has
    neither direction), and a ``flows`` object is there to be skipped.  A document holds at
    most 24 hours of at most one reading per source, whatever the number of events.
    """
    storage = F.col("source").startswith("hydro_storage_")
    plain = F.collect_list(
        F.when(~storage, _member(F.col("source"), _number(F.col("power_mw"))))
    )
    directions = F.collect_list(
        F.when(storage, _member(
            F.replace("source", F.lit("hydro_storage_")), _number(F.col("power_mw"))
        ))
    )
    hours = (
        delivered_readings(spark, sf_dir)
        .groupBy("zone", "datetime_utc", "ingested_at")
        .agg(
            F.sort_array(plain).alias("plain"),
            F.sort_array(directions).alias("directions"),
            F.max("estimation_method").alias("estimation_method"),
            F.max("updated_at").alias("updated_at"),
        )
    )
    mix = _object(
        F.concat(
            F.col("plain"),
            F.array(
                _member(F.lit("hydro storage"), _object(F.col("directions"))),
                F.lit('"flows":{"imports":1.5,"exports":null}'),
            ),
        )
    )
    method = F.coalesce(
        F.concat(F.lit('"'), "estimation_method", F.lit('"')), F.lit("null")
    )
    entry = F.concat(
        F.lit('{"datetime":"'), F.date_format("datetime_utc", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"),
        F.lit('","updatedAt":"'), format_iso(F.col("updated_at")),
        F.lit('","estimationMethod":'), method,
        F.lit(',"breakdownType":"normal","mix":'), mix, F.lit("}"),
    )
    return _responses(
        hours.withColumn("entry", entry), F.to_date("datetime_utc")
    )


def multi_line(responses: DataFrame) -> DataFrame:
    """The same responses with every history entry on a line of its own."""
    broken = F.regexp_replace("response", r'\{"datetime"', '\n  {"datetime"')
    return responses.withColumn("response", broken)


def iso_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event's time as ISO text in one of six forms: Z with milliseconds, two offsets, with
    microseconds or none, no fraction, empty and missing."""
    ts, form = F.col("ts"), F.col("event_id") % 6

    def text(hours: str, pattern: str) -> Column:
        return F.date_format(F.expr(f"ts + INTERVAL {hours}"), pattern)

    written = (
        F.when(form == 0, text("0 HOUR", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
        .when(form == 1, text("2 HOUR", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+02:00'"))
        .when(form == 2, text("-330 MINUTE", "yyyy-MM-dd'T'HH:mm:ss'-05:30'"))
        .when(form == 3, text("0 HOUR", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(form == 4, F.lit(""))
    )
    return table(spark, sf_dir, "events").select("event_id", ts, written.alias("written"))


def flow_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order line as a flow between the customer's and the supplier's nation.

    Returned lines are imports, all others exports; lines within one nation are no exchange.
    """
    nation = table(spark, sf_dir, "nation")
    buyers = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("o_orderkey", F.col("n_name").alias("zone"))
    )
    seller_nation = nation.select(
        F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("counterpart_zone")
    )
    returned = F.col("l_returnflag") == "R"
    # Customers meet the orders first: the lines, by far the largest table, are then joined
    # by order once instead of being shuffled again by customer.
    return (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(seller_nation, "s_nationkey")
        .join(buyers, F.col("l_orderkey") == F.col("o_orderkey"))
        .filter(F.col("zone") != F.col("counterpart_zone"))
        .select(
            "zone",
            F.col("l_shipdate").alias("datetime_utc"),
            "counterpart_zone",
            F.when(returned, F.col("l_quantity")).otherwise(0.0).alias("import_mw"),
            F.when(returned, 0.0).otherwise(F.col("l_quantity")).alias("export_mw"),
        )
    )


def flow_responses(
    spark: SparkSession, sf_dir: str, unreported_day: int | None = None
) -> DataFrame:
    """Flows as raw JSON: one document per zone and month, an entry per time.

    A direction without flow leaves its key out; of a given day of the month only the
    partners are known, their amounts are null.
    """
    totals = (
        flow_readings(spark, sf_dir)
        .groupBy("zone", "datetime_utc", "counterpart_zone")
        .agg(F.sum("import_mw").alias("import_mw"), F.sum("export_mw").alias("export_mw"))
    )

    def members(amount: str) -> Column:
        value = F.col(amount)
        limited = value
        if unreported_day:
            limited = F.when(F.dayofmonth("datetime_utc") != unreported_day, value)
        return F.sort_array(
            F.collect_list(F.when(value > 0, _member(F.col("counterpart_zone"), _number(limited))))
        )

    entry = F.concat(
        F.lit('{"datetime":"'), format_iso(F.col("datetime_utc")),
        F.lit('","updatedAt":null,"import":'), _object(F.col("imports")),
        F.lit(',"export":'), _object(F.col("exports")), F.lit("}"),
    )
    hours = (
        totals.groupBy("zone", "datetime_utc")
        .agg(members("import_mw").alias("imports"), members("export_mw").alias("exports"))
        .withColumn("entry", entry)
        .withColumn("ingested_at", F.to_timestamp(F.lit("2003-01-01 00:00:00")))
    )
    return _responses(hours, month_of(F.col("datetime_utc")))


def priority_energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a daily mix: the priority is the source and the price its energy."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.to_date("o_orderdate").alias("date_utc"), F.col("o_orderpriority").alias("source"))
        .agg(F.sum("o_totalprice").alias("energy_mwh"))
    )


# Order priorities grouped into report series, in stacking order.
PRIORITY_GROUPS = {
    "Rush": ["1-URGENT", "2-HIGH"],
    "Normal": ["3-MEDIUM", "4-NOT SPECIFIED"],
    "Slow": ["5-LOW"],
}

"""Nested JSON documents to long, typed rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattlake.functions.times import date_parts, parse_iso
from wattlake.functions.values import key_union, required, value_or

#: Quoted "NaN" and "Infinity" are refused like any quoted number.
FAIL_FAST = {"mode": "FAILFAST", "allowNonNumericNumbers": "false"}
POSITION = "entry_position"


def _entries(
    records: DataFrame, entry_fields: str, text: str, carry: Sequence[str]
) -> DataFrame:
    """One row per history entry of each document, with the document's fields next to it."""
    document = F.from_json(
        text,
        "ingested_at string, response struct<zone string, "
        f"history array<struct<datetime string, updatedAt string, {entry_fields}>>>",
        FAIL_FAST,
    )
    response = F.col("document.response")
    entry = F.col("entry")
    return (
        records.select(*carry, document.alias("document"))
        # The document's own fields become columns first, so that exploding the history does
        # not copy the whole document to every entry.
        .select(
            *carry,
            required(response["zone"], "response.zone").alias("zone"),
            parse_iso(required(F.col("document.ingested_at"), "ingested_at")).alias("ingested_at"),
            response["history"].alias("history"),
        )
        .select(
            *carry,
            "zone",
            "ingested_at",
            F.posexplode(required(F.col("history"), "response.history")).alias(POSITION, "entry"),
        )
        .select(
            *carry,
            POSITION,
            "zone",
            "ingested_at",
            parse_iso(required(entry["datetime"], "datetime")).alias("datetime_utc"),
            parse_iso(entry["updatedAt"]).alias("updated_at"),
            "entry",
        )
    )


def is_estimated(method: Column) -> Column:
    """Every named method other than MEASURED is an estimate; no method is not."""
    return F.coalesce(method != "MEASURED", F.lit(False))


def _number(reading: Column) -> Column:
    """A VARIANT number or null as a double; anything else, quoted numbers too, fails."""
    kind = F.schema_of_variant(reading)
    numeric = kind.isin("VOID", "BIGINT", "DOUBLE") | kind.startswith("DECIMAL")
    refused = F.raise_error(F.concat(F.lit("not a number: "), F.to_json(reading)))
    return F.when(numeric, F.variant_get(reading, "$", "double")).otherwise(refused)


def flatten_mix(
    records: DataFrame, text: str = "value", carry: Sequence[str] = (), skip: str = "flows"
) -> DataFrame:
    """One row per zone, hour and source.

    A ``mix`` value is a number, null, or an object such as a storage's charge and discharge,
    which becomes one row per inner key (an empty object: none).  VARIANT keeps the JSON type
    of each value, so objects are recognised without text tests and quoted numbers refused.
    """
    entries = _entries(
        records, "estimationMethod string, mix map<string,variant>", text, carry
    )
    shared = [*carry, POSITION, "zone", "datetime_utc", "estimation_method", "updated_at",
              "ingested_at"]
    is_object = F.schema_of_variant("reading").startswith("OBJECT")
    values = (
        entries.withColumn("estimation_method", F.col("entry.estimationMethod"))
        .select(*shared, F.explode(required(F.col("entry.mix"), "mix")).alias("name", "reading"))
        .filter(F.col("name") != skip)
        .withColumn("nested", is_object)
    )
    nested, part = F.col("nested"), F.col("part")
    inner = F.when(nested, F.variant_get("reading", "$", "map<string,variant>"))
    source = F.when(nested, F.concat("name", F.lit("_"), part)).otherwise(F.col("name"))
    power = F.when(nested, F.col("part_reading")).otherwise(F.col("reading"))
    # The outer explode keeps a plain value as one row without a part; an empty object's row
    # without a part is dropped.
    return (
        values.select(
            *shared,
            "name",
            "reading",
            "nested",
            F.explode_outer(inner).alias("part", "part_reading"),
        )
        .filter(~nested | part.isNotNull())
        .select(
            *carry,
            *([POSITION] if carry else []),
            "zone",
            "datetime_utc",
            F.replace(source, F.lit(" "), F.lit("_")).alias("source"),
            _number(power).alias("power_mw"),
            "estimation_method",
            is_estimated(F.col("estimation_method")).alias("is_estimated"),
            "updated_at",
            "ingested_at",
        )
    )


def flatten_flows(
    records: DataFrame, text: str = "value", carry: Sequence[str] = ()
) -> DataFrame:
    """One row per zone, hour and counterpart named in the import or the export map.

    A counterpart absent from one map exchanges 0 in that direction; a stored null stays null.
    """
    entries = _entries(
        records, "import map<string,double>, export map<string,double>", text, carry
    )
    imports, exports = F.col("entry.import"), F.col("entry.export")
    counterpart = F.col("counterpart_zone")
    return entries.withColumn(
        "counterpart_zone", F.explode(key_union(imports, exports))
    ).select(
        *carry,
        *([POSITION] if carry else []),
        "zone",
        "datetime_utc",
        "counterpart_zone",
        value_or(imports, counterpart, F.lit(0.0)).alias("import_mw"),
        value_or(exports, counterpart, F.lit(0.0)).alias("export_mw"),
        "updated_at",
        "ingested_at",
    )


def add_partition_columns(df: DataFrame, time_col: str = "datetime_utc") -> DataFrame:
    return df.withColumns(date_parts(F.col(time_col)))

"""Table contracts: column types, natural key, partitioning and row rules."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import types as T


def not_null(*columns: str) -> str:
    return " AND ".join(f"{column} IS NOT NULL" for column in columns)


def at_least_zero(*columns: str, nullable: bool = False) -> str:
    """A null satisfies the rule only when ``nullable`` says so; NaN never does."""
    tests = [
        f"{c} >= 0 AND NOT isnan({c})" + (f" OR {c} IS NULL" if nullable else "")
        for c in columns
    ]
    return " AND ".join(f"({test})" for test in tests)


@dataclass(frozen=True)
class TableContract:
    name: str
    schema: T.StructType
    key: tuple[str, ...]
    partition_by: tuple[str, ...]
    rules: Mapping[str, str]

    @property
    def data_columns(self) -> list[str]:
        return [name for name in self.schema.names if name not in self.partition_by]


_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
}


def _table(name: str, columns: str, key: str, partition_by: str, rules: Mapping[str, str]):
    """A contract from ``name type`` pairs, readable before any session exists."""
    pairs = (pair.split() for pair in columns.split(","))
    schema = T.StructType([T.StructField(column, _TYPES[kind]) for column, kind in pairs])
    return TableContract(name, schema, tuple(key.split()), tuple(partition_by.split()), rules)


# Table, column and rule names of the lake.
MIX = _table(
    "electricity_mix",
    """zone string, datetime_utc timestamp, source string, power_mw double,
       estimation_method string, is_estimated boolean, updated_at timestamp,
       ingested_at timestamp, year string, month string, day string""",
    key="zone datetime_utc source",
    partition_by="year month day",
    rules={
        "key_not_null": not_null("zone", "datetime_utc", "source"),
        "power_non_negative": at_least_zero("power_mw", nullable=True),
    },
)

FLOWS = _table(
    "electricity_flows",
    """zone string, datetime_utc timestamp, counterpart_zone string, import_mw double,
       export_mw double, updated_at timestamp, ingested_at timestamp,
       year string, month string, day string""",
    key="zone datetime_utc counterpart_zone",
    partition_by="year month day",
    rules={
        "key_not_null": not_null("zone", "datetime_utc", "counterpart_zone"),
        "flows_non_negative": at_least_zero("import_mw", "export_mw"),
    },
)

DAILY_MIX = _table(
    "daily_relative_mix",
    """date_utc date, period_start_utc timestamp, period_end_utc timestamp,
       hours_covered int, zone string, zone_name string, country_code string,
       source string, energy_mwh double, percentage double, year string""",
    key="date_utc zone source",
    partition_by="year",
    rules={"percentage_range": "percentage IS NULL OR percentage BETWEEN 0 AND 100"},
)

_EXCHANGE_COLUMNS = """date_utc date, period_start_utc timestamp, period_end_utc timestamp,
       hours_covered int, from_zone string, from_zone_name string, from_country_code string,
       to_zone string, to_zone_name string, to_country_code string, net_mwh double, year string"""
_EXCHANGE = dict(
    key="date_utc from_zone to_zone", partition_by="year", rules={"net_positive": "net_mwh > 0 AND NOT isnan(net_mwh)"}
)
DAILY_IMPORTS = _table("fr_daily_imports", _EXCHANGE_COLUMNS, **_EXCHANGE)
DAILY_EXPORTS = _table("fr_daily_exports", _EXCHANGE_COLUMNS, **_EXCHANGE)

# Production sources per report series, in stacking order.
SOURCE_GROUPS = {
    "Nuclear": ["nuclear"],
    "Hydro": ["hydro", "hydro_storage_discharge"],
    "Wind": ["wind"],
    "Solar": ["solar"],
    "Gas": ["gas"],
    "Coal & oil": ["coal", "oil"],
    "Other": ["biomass", "battery_storage_discharge", "geothermal", "unknown"],
}

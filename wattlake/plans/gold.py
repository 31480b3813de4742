"""Gold builds: daily products recomputed from Silver and replaced as a whole."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wattlake.operators.daily import daily_net_flows, daily_relative_mix, exchange_table
from wattlake.schemas import (
    DAILY_EXPORTS,
    DAILY_IMPORTS,
    DAILY_MIX,
    FLOWS,
    MIX,
    TableContract,
)
from wattlake.session import require_utc
from wattlake.sources.tables import read_table, replace_table, staged, table_path


def _silver(spark: SparkSession, lake: str, contract: TableContract) -> DataFrame:
    require_utc(spark)
    return read_table(spark, table_path(lake, "silver", contract.name), contract)


def _replace(df: DataFrame, lake: str, contract: TableContract) -> None:
    replace_table(df, table_path(lake, "gold", contract.name), contract)


def build_daily_relative_mix(spark: SparkSession, lake: str, zones: DataFrame) -> None:
    mix = _silver(spark, lake, MIX)
    _replace(daily_relative_mix(mix, zones, ordered=False), lake, DAILY_MIX)


def build_daily_exchange(spark: SparkSession, lake: str, zones: DataFrame) -> None:
    """Imports and exports from one pass over Silver: the netted days are staged for both."""
    with staged(daily_net_flows(_silver(spark, lake, FLOWS)), "net-flows") as net:
        _replace(exchange_table(net, zones, "import", ordered=False), lake, DAILY_IMPORTS)
        _replace(exchange_table(net, zones, "export", ordered=False), lake, DAILY_EXPORTS)

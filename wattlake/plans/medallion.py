"""The whole run over landed Bronze documents, with the checks between the layers."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from wattlake.operators.quality import (
    CheckResult,
    no_missing_hours_of,
    percentages_sum_to_100,
    unique_key_of,
)
from wattlake.plans.gold import build_daily_exchange, build_daily_relative_mix
from wattlake.plans.silver import STREAMS, load_new_bronze, rebuild
from wattlake.schemas import DAILY_EXPORTS, DAILY_IMPORTS, DAILY_MIX, FLOWS, MIX
from wattlake.sources.files import exists
from wattlake.sources.summaries import refresh_summary
from wattlake.sources.tables import finish_merge, read_table, table_exists, table_path


@dataclass
class RunReport:
    """What a run loaded, which checks failed how, and which Gold tables it left out."""

    files_loaded: dict[str, int] = field(default_factory=dict)
    checks: dict[str, CheckResult] = field(default_factory=dict)
    warnings: list[str] = field(default_factory=list)
    errors: list[str] = field(default_factory=list)
    not_built: list[str] = field(default_factory=list)

    def record(self, name: str, result: CheckResult, warning: bool = False) -> bool:
        self.checks[name] = result
        if not result.passed:
            (self.warnings if warning else self.errors).append(f"{name}: {result.description}")
        return result.passed

    @property
    def succeeded(self) -> bool:
        return not self.errors


def run(
    spark: SparkSession,
    lake: str,
    zones: DataFrame,
    now: datetime | None = None,
    layout: str = "files",
) -> RunReport:
    """Load what is new in Bronze into Silver, check it and rebuild Gold."""
    report = RunReport()
    for name in STREAMS:
        report.files_loaded[name] = load_new_bronze(spark, lake, name, now, layout)
    return build_checked(spark, lake, zones, report)


def rebuild_all(
    spark: SparkSession, lake: str, zones: DataFrame, layout: str = "files"
) -> RunReport:
    """Recompute Silver from all of Bronze, drop the marks and rebuild Gold."""
    for name, stream in STREAMS.items():
        if exists(spark, stream.bronze(lake)):
            rebuild(spark, lake, name, layout)
    return build_checked(spark, lake, zones, RunReport())


def build_checked(
    spark: SparkSession, lake: str, zones: DataFrame, report: RunReport
) -> RunReport:
    """Gold from Silver, with the checks.

    The Silver checks work on summaries kept per day, renewed where files have changed.  A Silver
    table with duplicate keys blocks the Gold tables built from it, and only those.
    Missing hours are a warning; percentages not adding up are an error found after the build.
    """
    products = {
        MIX.name: (build_daily_relative_mix, [DAILY_MIX.name]),
        FLOWS.name: (build_daily_exchange, [DAILY_IMPORTS.name, DAILY_EXPORTS.name]),
    }
    for name, stream in STREAMS.items():
        build, gold_tables = products[name]
        if not table_exists(spark, stream.silver(lake)):
            report.not_built.extend(gold_tables)
            continue
        finish_merge(spark, stream.silver(lake), stream.contract)
        days, _ = refresh_summary(spark, lake, stream.contract)
        if not report.record(f"{name}_unique_key", unique_key_of(days, stream.contract.key)):
            report.not_built.extend(gold_tables)
            continue
        if name == MIX.name:
            report.record(f"{name}_no_missing_hours", no_missing_hours_of(days), warning=True)
        build(spark, lake, zones)
    if DAILY_MIX.name not in report.not_built:
        daily = read_table(spark, table_path(lake, "gold", DAILY_MIX.name), DAILY_MIX)
        report.record(f"{DAILY_MIX.name}_sum_to_100", percentages_sum_to_100(daily))
    return report

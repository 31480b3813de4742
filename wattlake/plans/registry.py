"""Named queries over the supplied tables, each with the same question in plain SQL.

A query takes ``(spark, sf_dir)`` and returns a DataFrame.  Amounts are rounded to six decimals
on both sides because sums of doubles depend on the order of the rows.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattlake.functions.times import parse_iso
from wattlake.functions.values import strict_group
from wattlake.operators.contract import SchemaMismatch, drift, violations
from wattlake.operators.daily import (
    daily_exports,
    daily_imports,
    daily_net_flows,
    daily_relative_mix,
    exchange_table,
)
from wattlake.operators.dedupe import deduplicate
from wattlake.operators.flatten import POSITION, add_partition_columns, flatten_flows, flatten_mix
from wattlake.operators.quality import (
    duplicate_rows,
    first_missing,
    key_counts,
    missing_hours,
    no_missing_hours_of,
    percentage_totals,
    unique_key_of,
)
from wattlake.operators.report import (
    column_profile,
    full_months,
    last_month_labels,
    latest_rows,
    monthly_group_shares,
    monthly_mix_share,
    monthly_net_exchange,
    profile,
    signed_exchange,
    stack_positions,
    top_partners,
)
from wattlake.plans.gold import build_daily_exchange, build_daily_relative_mix
from wattlake.plans.medallion import RunReport, build_checked, run
from wattlake.plans.silver import find_late, load_late, load_new_bronze, rebuild
from wattlake.plans.warehouse import (
    PRIORITY_GROUPS,
    delivered_rows,
    flow_readings,
    flow_responses,
    iso_texts,
    mix_readings,
    mix_responses,
    multi_line,
    priority_energy,
    table,
    zones,
)
from wattlake.schemas import (
    DAILY_EXPORTS,
    DAILY_IMPORTS,
    DAILY_MIX,
    FLOWS,
    MIX,
    TableContract,
)
from wattlake.session import configure, scratch_path
from wattlake.sources import files
from wattlake.sources.bronze import file_in, land, land_files, provenance, records_since
from wattlake.sources.state import read_mark, write_mark
from wattlake.sources.summaries import fingerprints, refresh_summary
from wattlake.sources.tables import (
    create_table,
    finish_merge,
    read_table,
    replace_table,
    stage_merge,
    table_path,
    touched_folders,
    upsert,
)
from wattlake.sources.zones import load_zones
from wattlake.streaming.silver import checkpoint_path, load_available

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

# Named pieces of SQL shared by the questions below.
_VIEWS = {
    "zones": """
        SELECT n_name AS zone, n_name AS zone_name, r_name AS country_code
        FROM nation JOIN region ON r_regionkey = n_regionkey""",
    "mix": """
        SELECT n_name AS zone, date_trunc('hour', ts) AS datetime_utc,
               CASE event_type WHEN 'error' THEN 'hydro_storage_charge'
                    WHEN 'purchase' THEN 'hydro_storage_discharge' ELSE event_type END AS source,
               {power} AS power_mw,
               CASE WHEN value < 10 THEN NULL WHEN value < 20 THEN 'SURROGATE'
                    WHEN value < 30 THEN 'ESTIMATED' ELSE 'MEASURED' END AS estimation_method,
               value >= 10 AND value < 30 AS is_estimated,
               ts AS updated_at, ts AS ingested_at, event_id
        FROM events JOIN customer ON c_custkey = user_id
                    JOIN nation ON n_nationkey = c_nationkey""",
    "delivered": """
        SELECT zone, datetime_utc, source, power_mw,
               max(estimation_method) OVER hour AS estimation_method,
               coalesce(max(estimation_method) OVER hour <> 'MEASURED', false) AS is_estimated,
               max(updated_at) OVER hour AS updated_at, delivered_at AS ingested_at,
               strftime(datetime_utc, '%Y') AS year, strftime(datetime_utc, '%m') AS month,
               strftime(datetime_utc, '%d') AS day
        FROM (
            SELECT *, row_number() OVER (
                PARTITION BY zone, datetime_utc, source, delivered_at
                ORDER BY updated_at DESC, event_id DESC) AS newest
            FROM (
                SELECT *, date_trunc('day', updated_at)
                       + CASE WHEN extract(minute FROM updated_at) < 30
                              THEN INTERVAL 24 HOUR ELSE INTERVAL 30 HOUR END AS delivered_at
                FROM mix))
        WHERE newest = 1
        WINDOW hour AS (PARTITION BY zone, datetime_utc, delivered_at)""",
    "silver": """
        SELECT zone, datetime_utc, source, power_mw, estimation_method, is_estimated,
               updated_at, ingested_at, year, month, day
        FROM (SELECT *, row_number() OVER (PARTITION BY zone, datetime_utc, source
                                           ORDER BY ingested_at DESC) AS newest
              FROM delivered)
        WHERE newest = 1""",
    "flows": """
        SELECT b.n_name AS zone, s.n_name AS counterpart_zone, l_shipdate AS datetime_utc,
               CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END AS import_mw,
               CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_quantity END AS export_mw
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey
             JOIN customer ON c_custkey = o_custkey
             JOIN supplier ON s_suppkey = l_suppkey
             JOIN nation b ON b.n_nationkey = c_nationkey
             JOIN nation s ON s.n_nationkey = s_nationkey
        WHERE b.n_name <> s.n_name""",
    "net": """
        SELECT zone, counterpart_zone, CAST(datetime_utc AS DATE) AS date_utc,
               sum(import_mw) AS import_mwh, sum(export_mw) AS export_mwh,
               CAST(count(DISTINCT datetime_utc) AS INTEGER) AS hours_covered,
               sum(import_mw) - sum(export_mw) AS net_import_mwh
        FROM flows GROUP BY 1, 2, 3""",
    "signed": """
        SELECT date_utc, zone, counterpart_zone, net_import_mwh,
               CASE WHEN net_import_mwh > 0 THEN counterpart_zone ELSE zone END AS from_zone,
               CASE WHEN net_import_mwh > 0 THEN zone ELSE counterpart_zone END AS to_zone,
               hours_covered
        FROM net WHERE net_import_mwh <> 0""",
    "neighbours": """
        SELECT date_utc, to_zone AS neighbour, -net_import_mwh AS net
        FROM signed WHERE net_import_mwh < 0
        UNION ALL
        SELECT date_utc, from_zone AS neighbour, -net_import_mwh AS net
        FROM signed WHERE net_import_mwh > 0""",
    "monthly_net": """
        SELECT CAST(date_trunc('month', date_utc) AS DATE) AS month, neighbour,
               neighbour AS name, sum(net) / 1000 AS net_gwh
        FROM neighbours
        WHERE date_trunc('month', date_utc) IN (
            SELECT date_trunc('month', date_utc) FROM neighbours GROUP BY 1
            HAVING count(DISTINCT date_utc) = max(day(last_day(date_utc))))
        GROUP BY 1, 2""",
    "priorities": """
        SELECT CAST(o_orderdate AS DATE) AS date_utc, o_orderpriority AS source,
               sum(o_totalprice) AS energy_mwh
        FROM orders GROUP BY 1, 2""",
    "shares": """
        SELECT month, series, e / sum(e) OVER (PARTITION BY month) * 100 AS share,
               CASE series WHEN 'Rush' THEN 1 WHEN 'Normal' THEN 2 ELSE 3 END AS place
        FROM (
            SELECT CAST(date_trunc('month', date_utc) AS DATE) AS month,
                   CASE WHEN source IN ('1-URGENT', '2-HIGH') THEN 'Rush'
                        WHEN source = '5-LOW' THEN 'Slow' ELSE 'Normal' END AS series,
                   sum(energy_mwh) AS e
            FROM priorities
            WHERE date_trunc('month', date_utc) IN (
                SELECT date_trunc('month', date_utc) FROM priorities GROUP BY 1
                HAVING count(DISTINCT date_utc) = max(day(last_day(date_utc))))
            GROUP BY 1, 2)""",
    "stacked": """
        SELECT month, series, share, coalesce(sum(share) OVER (
                   PARTITION BY month ORDER BY place
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bottom
        FROM shares""",
    "daily_mix": """
        SELECT date_utc, CAST(date_utc AS TIMESTAMP) AS period_start_utc,
               CAST(date_utc AS TIMESTAMP) + INTERVAL 1 DAY AS period_end_utc, hours_covered,
               d.zone, zone_name, country_code, source, energy_mwh,
               CASE WHEN sum(energy_mwh) OVER zone_day > 0
                    THEN energy_mwh / sum(energy_mwh) OVER zone_day * 100 END AS percentage,
               strftime(date_utc, '%Y') AS year
        FROM (
            SELECT zone, CAST(datetime_utc AS DATE) AS date_utc, source,
                   sum(coalesce(power_mw, 0)) AS energy_mwh,
                   CAST(count(DISTINCT datetime_utc) AS INTEGER) AS hours_covered
            FROM {readings} WHERE NOT ends_with(source, '_charge') GROUP BY 1, 2, 3) d
        LEFT JOIN zones z ON z.zone = d.zone
        WINDOW zone_day AS (PARTITION BY d.zone, date_utc)""",
}


def _with(names: str, question: str, **pieces: str) -> str:
    pieces = {"power": "CASE WHEN extract(minute FROM ts) <> 7 THEN value END"} | pieces
    views = ",\n".join(f"{name} AS ({_VIEWS[name].format(**pieces)})" for name in names.split())
    return f"WITH {views}\n{question}"


def _query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            return _comparable(build(configure(spark), sf_dir))

        _QUERIES[name] = query
        if sql is not None:
            _SQL[name] = sql
        return build

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _comparable(df: DataFrame) -> DataFrame:
    """Zone-less timestamps and rounded amounts, as the SQL side returns them."""

    def column(field: T.StructField):
        if isinstance(field.dataType, T.TimestampType):
            return F.col(field.name).cast("timestamp_ntz").alias(field.name)
        if isinstance(field.dataType, T.DoubleType):
            return F.round(field.name, 6).alias(field.name)
        return F.col(field.name)

    return df.select(*(column(field) for field in df.schema))


def _fresh_lake(spark: SparkSession, purpose: str) -> str:
    return scratch_path(spark, purpose)


# --- Gold products -----------------------------------------------------------------------

_DAILY_MIX_ROWS = """
    SELECT date_utc, period_start_utc, period_end_utc, hours_covered, zone, zone_name,
           country_code, source, round(energy_mwh, 6) AS energy_mwh,
           round(percentage, 6) AS percentage, year
    FROM daily_mix"""


@_query("daily_relative_mix", _with("zones mix daily_mix", _DAILY_MIX_ROWS, readings="mix"))
def _daily_relative_mix(spark, sf_dir):
    return daily_relative_mix(mix_readings(spark, sf_dir), zones(spark, sf_dir))


@_query(
    "local_day_mix",
    _with(
        "zones mix",
        """SELECT date_utc,
                  timezone('UTC', timezone('Europe/Paris', CAST(date_utc AS TIMESTAMP)))
                      AS period_start_utc,
                  timezone('UTC', timezone('Europe/Paris', CAST(date_utc + 1 AS TIMESTAMP)))
                      AS period_end_utc,
                  hours_covered, d.zone, zone_name, country_code, source,
                  round(energy_mwh, 6) AS energy_mwh,
                  round(CASE WHEN sum(energy_mwh) OVER zone_day > 0
                             THEN energy_mwh / sum(energy_mwh) OVER zone_day * 100 END, 6)
                      AS percentage,
                  strftime(date_utc, '%Y') AS year
           FROM (SELECT zone, source, sum(coalesce(power_mw, 0)) AS energy_mwh,
                        CAST(timezone('Europe/Paris', timezone('UTC', datetime_utc)) AS DATE)
                            AS date_utc,
                        CAST(count(DISTINCT datetime_utc) AS INTEGER) AS hours_covered
                 FROM mix WHERE NOT ends_with(source, '_charge') GROUP BY 1, 2, 4) d
           LEFT JOIN zones z ON z.zone = d.zone
           WINDOW zone_day AS (PARTITION BY d.zone, date_utc)""",
        power="value",
    ),
)
def _local_day_mix(spark, sf_dir):
    """Local days of every event's value, none left unreported."""
    readings = mix_readings(spark, sf_dir, gaps=False)
    return daily_relative_mix(readings, zones(spark, sf_dir), time_zone="Europe/Paris")


def _exchange_sql(test: str) -> str:
    return _with(
        "zones flows net signed",
        f"""SELECT date_utc, CAST(date_utc AS TIMESTAMP) AS period_start_utc,
                   CAST(date_utc AS TIMESTAMP) + INTERVAL 1 DAY AS period_end_utc, hours_covered,
                   from_zone, f.zone_name AS from_zone_name, f.country_code AS from_country_code,
                   to_zone, t.zone_name AS to_zone_name, t.country_code AS to_country_code,
                   round(abs(net_import_mwh), 6) AS net_mwh, strftime(date_utc, '%Y') AS year
            FROM signed LEFT JOIN zones f ON f.zone = from_zone
                        LEFT JOIN zones t ON t.zone = to_zone
            WHERE net_import_mwh {test}""",
    )


@_query("daily_imports", _exchange_sql("> 0"))
def _daily_imports(spark, sf_dir):
    return daily_imports(flow_readings(spark, sf_dir), zones(spark, sf_dir))


@_query("daily_exports", _exchange_sql("< 0"))
def _daily_exports(spark, sf_dir):
    return daily_exports(flow_readings(spark, sf_dir), zones(spark, sf_dir))


@_query("daily_net_flows", _with("flows net", "SELECT * FROM net"))
def _daily_net_flows(spark, sf_dir):
    return daily_net_flows(flow_readings(spark, sf_dir))


# --- Flattening, keys and partitions ------------------------------------------------------


@_query(
    "dedupe_latest",
    _with(
        "mix",
        """SELECT * EXCLUDE (newest) FROM (
               SELECT *, row_number() OVER (PARTITION BY zone, datetime_utc, source
                                            ORDER BY ingested_at DESC, event_id DESC) AS newest
               FROM mix) WHERE newest = 1""",
    ),
)
def _dedupe_latest(spark, sf_dir):
    return deduplicate(mix_readings(spark, sf_dir), MIX.key, tie_break=["event_id"])


def _landed_mix(spark, sf_dir, lake: str) -> str:
    root = table_path(lake, "bronze", MIX.name)
    land(mix_responses(spark, sf_dir), root)
    return root


@_query(
    "flatten_mix_roundtrip",
    _with("mix delivered", "SELECT * EXCLUDE (year, month, day) FROM delivered"),
)
def _flatten_mix_roundtrip(spark, sf_dir):
    root = _landed_mix(spark, sf_dir, _fresh_lake(spark, "flatten-mix"))
    return flatten_mix(records_since(spark, root, layout="lines"))


_EXCHANGED = """
    SELECT zone, datetime_utc, counterpart_zone,
           CASE WHEN import_mw = 0 OR day(datetime_utc) <> 13 THEN import_mw END AS import_mw,
           CASE WHEN export_mw = 0 OR day(datetime_utc) <> 13 THEN export_mw END AS export_mw,
           CAST(NULL AS TIMESTAMP) AS updated_at, TIMESTAMP '2003-01-01' AS ingested_at
    FROM (SELECT zone, datetime_utc, counterpart_zone, sum(import_mw) AS import_mw,
                 sum(export_mw) AS export_mw
          FROM flows GROUP BY 1, 2, 3)"""


@_query("flatten_flows_roundtrip", _with("flows", _EXCHANGED))
def _flatten_flows_roundtrip(spark, sf_dir):
    root = table_path(_fresh_lake(spark, "flatten-flows"), "bronze", FLOWS.name)
    land(flow_responses(spark, sf_dir, unreported_day=13), root)
    return flatten_flows(records_since(spark, root, layout="lines"))


@_query("zones_from_json", _with("zones", "SELECT * FROM zones"))
def _zones_from_json(spark, sf_dir):
    info = F.struct(
        F.col("zone_name").alias("zoneName"), F.col("country_code").alias("countryCode")
    )
    document = (
        zones(spark, sf_dir)
        .agg(F.map_from_entries(F.collect_list(F.struct("zone", info))).alias("zones"))
        .select(F.to_json("zones").alias("value"))
    )
    uri = _fresh_lake(spark, "zones")
    document.write.text(uri)
    return load_zones(spark, uri)


@_query(
    "add_partitions",
    _with(
        "mix",
        """SELECT event_id, zone, datetime_utc, strftime(datetime_utc, '%Y') AS year,
                  strftime(datetime_utc, '%m') AS month, strftime(datetime_utc, '%d') AS day
           FROM mix""",
    ),
)
def _add_partitions(spark, sf_dir):
    readings = mix_readings(spark, sf_dir).select("event_id", "zone", "datetime_utc")
    return add_partition_columns(readings)


@_query(
    "provenance_filter",
    _with("mix", "SELECT * FROM mix WHERE estimation_method = 'SURROGATE'"),
)
def _provenance_filter(spark, sf_dir):
    return mix_readings(spark, sf_dir).filter(F.col("estimation_method") == "SURROGATE")


# --- Checks -------------------------------------------------------------------------------


@_query(
    "unique_key_violations",
    """SELECT l_orderkey, l_linenumber, count(*) - 1 AS duplicates FROM lineitem
       GROUP BY 1, 2 HAVING count(*) > 1""",
)
def _unique_key_violations(spark, sf_dir):
    return key_counts(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@_query(
    "duplicate_rows",
    """SELECT CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber
                                                     FROM lineitem)) AS BIGINT) AS duplicates
       FROM lineitem""",
)
def _duplicate_rows(spark, sf_dir):
    return duplicate_rows(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


_GAPS = _with(
    "mix",
    """SELECT zone, source, datetime_utc FROM (
           SELECT zone, source, unnest(generate_series(
                      min(datetime_utc), max(datetime_utc), INTERVAL 1 HOUR)) AS datetime_utc
           FROM mix GROUP BY zone, source) g
       WHERE NOT EXISTS (SELECT 1 FROM mix m
                         WHERE m.zone = g.zone AND m.source = g.source
                           AND m.datetime_utc = g.datetime_utc)""",
)
_SERIES = ["zone", "source"]


@_query("missing_hours", _GAPS)
def _missing_hours(spark, sf_dir):
    return missing_hours(mix_readings(spark, sf_dir), by=_SERIES)


@_query("missing_hours_sample", _GAPS + " ORDER BY datetime_utc, zone, source LIMIT 5")
def _missing_hours_sample(spark, sf_dir):
    return first_missing(missing_hours(mix_readings(spark, sf_dir), by=_SERIES), by=_SERIES)


@_query(
    "missing_hours_overall",
    """SELECT g.o_orderdate FROM (
           SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate),
                                         INTERVAL 1 HOUR)) AS o_orderdate FROM orders) g
       WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderdate = g.o_orderdate)""",
)
def _missing_hours_overall(spark, sf_dir):
    return missing_hours(table(spark, sf_dir, "orders"), "o_orderdate")


@_query(
    "percent_sum_check",
    _with(
        "zones mix daily_mix",
        """SELECT zone, date_utc, round(coalesce(sum(round(percentage, 1)), 0), 6) AS total
           FROM daily_mix GROUP BY 1, 2
           HAVING abs(coalesce(sum(round(percentage, 1)), 0) - 100) > 0.01""",
        readings="mix",
    ),
)
def _percent_sum_check(spark, sf_dir):
    """Percentages published with one decimal: the days on which rounding shows."""
    mix, names = mix_readings(spark, sf_dir), zones(spark, sf_dir)
    daily = daily_relative_mix(mix, names, ordered=False)
    return percentage_totals(daily.withColumn("percentage", F.round("percentage", 1)))


@_query(
    "percent_totals",
    _with(
        "zones mix daily_mix",
        """SELECT zone, date_utc, round(coalesce(sum(percentage), 0), 6) AS total
           FROM daily_mix GROUP BY 1, 2""",
        readings="mix",
    ),
)
def _percent_totals(spark, sf_dir):
    """The total of every zone and day, whether or not it passes the check."""
    daily = daily_relative_mix(mix_readings(spark, sf_dir), zones(spark, sf_dir), ordered=False)
    return percentage_totals(daily, tolerance=-1.0)


@_query(
    "contract_violations",
    _with(
        "mix",
        """SELECT 'key_not_null' AS rule, count(*) FILTER (power_mw > 100) AS violations
           FROM mix
           UNION ALL
           SELECT 'power_non_negative', count(*) FILTER (power_mw - 20 < 0) FROM mix""",
    ),
)
def _contract_violations(spark, sf_dir):
    power = F.col("power_mw")
    spoiled = mix_readings(spark, sf_dir).select(
        "zone",
        "datetime_utc",
        F.when(power > 100, F.lit(None)).otherwise(F.col("source")).alias("source"),
        (power - 20).alias("power_mw"),
    )
    return violations(spoiled, MIX)


# --- Tables and loads ---------------------------------------------------------------------

_SILVER_ROWS = _with("mix delivered silver", "SELECT * FROM silver")


@_query("merge_upsert", _SILVER_ROWS)
def _merge_upsert(spark, sf_dir):
    """First deliveries create the table, the revisions are merged into it."""
    uri = _fresh_lake(spark, "merge")
    rows = delivered_rows(spark, sf_dir)
    first_delivery = F.hour("ingested_at") == 0
    create_table(rows.filter(first_delivery), uri, MIX)
    upsert(rows.filter(~first_delivery), uri, MIX)
    return read_table(spark, uri, MIX)


@_query("merge_newer_only", _SILVER_ROWS)
def _merge_newer_only(spark, sf_dir):
    """The revisions arrive first; the older deliveries must not replace them."""
    uri = _fresh_lake(spark, "merge-newer")
    rows = delivered_rows(spark, sf_dir)
    first_delivery = F.hour("ingested_at") == 0
    create_table(rows.filter(~first_delivery), uri, MIX)
    upsert(rows.filter(first_delivery), uri, MIX, newer_only=True)
    return read_table(spark, uri, MIX)


@_query(
    "full_overwrite",
    _with("zones mix daily_mix", _DAILY_MIX_ROWS, readings="mix"),
)
def _full_overwrite(spark, sf_dir):
    """A table of the orders' years replaced by one of the events' year: no old year stays."""
    uri = _fresh_lake(spark, "overwrite")
    names = zones(spark, sf_dir)
    sales = table(spark, sf_dir, "orders").select(
        F.lit("SALES").alias("zone"),
        F.col("o_orderdate").alias("datetime_utc"),
        F.col("o_orderpriority").alias("source"),
        F.col("o_totalprice").alias("power_mw"),
    )
    replace_table(daily_relative_mix(sales, names, ordered=False), uri, DAILY_MIX)
    mix = mix_readings(spark, sf_dir)
    replace_table(daily_relative_mix(mix, names, ordered=False), uri, DAILY_MIX)
    return read_table(spark, uri, DAILY_MIX)


_NOW = datetime(2024, 12, 31, tzinfo=UTC)


def _early():
    """The first half of the delivered period."""
    return F.col("ingested_at") <= F.to_timestamp(F.lit("2024-01-16 00:00:00"))


def _loaded_in_two_runs(spark, sf_dir, purpose: str, layout: str = "lines") -> str:
    """Bronze arriving in two halves of the delivered period, loaded after each."""
    lake = _fresh_lake(spark, purpose)
    root = table_path(lake, "bronze", MIX.name)
    responses = multi_line(mix_responses(spark, sf_dir))
    write = land_files if layout == "files" else land
    write(responses.filter(_early()), root)
    load_new_bronze(spark, lake, MIX.name, _NOW, layout)
    write(responses.filter(~_early()), root)
    load_new_bronze(spark, lake, MIX.name, _NOW, layout)
    return lake


@_query("incremental_load", _SILVER_ROWS)
def _incremental_load(spark, sf_dir):
    lake = _loaded_in_two_runs(spark, sf_dir, "incremental")
    return read_table(spark, table_path(lake, "silver", MIX.name), MIX)


@_query("files_incremental", _SILVER_ROWS)
def _files_incremental(spark, sf_dir):
    """The same two runs over documents of several lines, one per stamped file."""
    lake = _loaded_in_two_runs(spark, sf_dir, "files-incremental", "files")
    return read_table(spark, table_path(lake, "silver", MIX.name), MIX)


@_query(
    "files_scan",
    _with("mix delivered", "SELECT * EXCLUDE (year, month, day), ingested_at AS stamp FROM delivered"),
)
def _files_scan(spark, sf_dir):
    """All of Bronze read back from one file per document, each with the stamp of its name."""
    root = table_path(_fresh_lake(spark, "files-scan"), "bronze", MIX.name)
    land_files(multi_line(mix_responses(spark, sf_dir)), root)
    return flatten_mix(records_since(spark, root), carry=["stamp"]).drop(POSITION)


def _with_late_files(spark, sf_dir, purpose: str) -> str:
    """A lake whose load has passed over one zone's files of the first half of the period."""
    lake = _fresh_lake(spark, purpose)
    root = table_path(lake, "bronze", MIX.name)
    responses = multi_line(mix_responses(spark, sf_dir))
    late = _early() & (F.col("zone") == "NATION_10")
    land_files(responses.filter(~late), root)
    load_new_bronze(spark, lake, MIX.name, _NOW)
    land_files(responses.filter(late), root)
    load_new_bronze(spark, lake, MIX.name, _NOW)
    return lake


@_query(
    "late_files",
    _with(
        "mix delivered silver",
        """SELECT zone, ingested_at AS stamp, 0 AS rows_before,
                  (SELECT count(*) FROM silver s
                   WHERE s.zone = d.zone AND s.ingested_at = d.ingested_at) AS rows_after
           FROM (SELECT DISTINCT zone, ingested_at FROM delivered
                 WHERE zone = 'NATION_10' AND ingested_at <= TIMESTAMP '2024-01-16 00:00:00') d""",
    ),
)
def _late_files(spark, sf_dir):
    """The audit names the files the mark has passed over; the stream, which remembers files, takes
    them.  Per file the rows in Silver that come from it, before and after the stream."""
    lake = _with_late_files(spark, sf_dir, "late-files")
    silver = table_path(lake, "silver", MIX.name)
    counts = lambda: read_table(spark, silver, MIX).groupBy("zone", "ingested_at").count()
    found = scratch_path(spark, "late-found")
    documents = records_since(spark, table_path(lake, "bronze", MIX.name))
    named = find_late(spark, lake, MIX.name).withColumnRenamed("stamp", "named_at")
    (
        documents.join(named, F.col("file") == file_in(F.col("source_file")))
        .select(F.get_json_object("value", "$.response.zone").alias("zone"), F.col("named_at").alias("stamp"))
        .join(counts().withColumnsRenamed({"ingested_at": "stamp", "count": "rows_before"}), ["zone", "stamp"], "left")
        .write.parquet(found)
    )
    load_available(spark, lake, MIX.name)
    after = counts().withColumnsRenamed({"ingested_at": "stamp", "count": "rows_after"})
    return spark.read.parquet(found).join(after, ["zone", "stamp"], "left").na.fill(0)


@_query("late_files_loaded", _SILVER_ROWS)
def _late_files_loaded(spark, sf_dir):
    """The batch load fetches what the audit names; nothing is late after that."""
    lake = _with_late_files(spark, sf_dir, "late-loaded")
    load_late(spark, lake, MIX.name)
    if not find_late(spark, lake, MIX.name).isEmpty():
        raise AssertionError("files are late after they were loaded")
    return read_table(spark, table_path(lake, "silver", MIX.name), MIX)


@_query("finished_merge", _SILVER_ROWS)
def _finished_merge(spark, sf_dir):
    """A merge whose driver was lost while publishing, one folder removed and not yet replaced: the
    next writer completes it from the staged rows."""
    uri = _fresh_lake(spark, "finished")
    rows = delivered_rows(spark, sf_dir)
    first_delivery = F.hour("ingested_at") == 0
    create_table(rows.filter(first_delivery), uri, MIX)
    stage_merge(rows.filter(~first_delivery), uri, MIX)
    files.delete(spark, files.join_path(uri, touched_folders(read_table(spark, uri, MIX), MIX)[0]))
    finish_merge(spark, uri, MIX)
    return read_table(spark, uri, MIX)


@_query(
    "repeated_batch",
    _with("mix delivered silver", "SELECT *, 0 AS partitions_rewritten FROM silver"),
)
def _repeated_batch(spark, sf_dir):
    """A micro-batch whose end the checkpoint has forgotten runs again and is recognised."""
    lake = _fresh_lake(spark, "repeated")
    _landed_mix(spark, sf_dir, lake)
    load_available(spark, lake, MIX.name, "lines")
    uri = table_path(lake, "silver", MIX.name)
    before = scratch_path(spark, "fingerprints")
    fingerprints(spark, uri, MIX).write.parquet(before)
    files.delete(spark, files.join_path(checkpoint_path(lake, MIX.name), "commits", "0"))
    load_available(spark, lake, MIX.name, "lines")
    changed = fingerprints(spark, uri, MIX).join(
        spark.read.schema("year string, month string, day string, fingerprint string").parquet(before),
        ["year", "month", "day", "fingerprint"], "left_anti",
    )
    return read_table(spark, uri, MIX).withColumn("partitions_rewritten", F.lit(changed.count()))


@_query(
    "kept_checks",
    _with(
        "mix delivered silver",
        """SELECT 'duplicates' AS fact, 0 AS n
           UNION ALL
           SELECT 'missing hours', date_diff('hour', min(datetime_utc), max(datetime_utc)) + 1
                  - count(DISTINCT datetime_utc) FROM silver
           UNION ALL
           SELECT CASE WHEN ingested_at <= TIMESTAMP '2024-01-16 00:00:00' THEN 'days read at first'
                       ELSE 'days read after the merge' END, count(DISTINCT CAST(datetime_utc AS DATE))
           FROM delivered GROUP BY 1
           UNION ALL
           SELECT 'days read after nothing', 0""",
    ),
)
def _kept_checks(spark, sf_dir):
    """Checks from day summaries: after a merge only the days it has touched are read."""
    uri_of, rows = _fresh_lake(spark, "kept"), delivered_rows(spark, sf_dir)
    uri = table_path(uri_of, "silver", MIX.name)

    def newest(part: DataFrame) -> DataFrame:
        return deduplicate(part, MIX.key)

    upsert(newest(rows.filter(_early())), uri, MIX)
    _, first = refresh_summary(spark, uri_of, MIX)
    upsert(newest(rows.filter(~_early())), uri, MIX)
    _, second = refresh_summary(spark, uri_of, MIX)
    summary, third = refresh_summary(spark, uri_of, MIX)
    facts = [
        ("duplicates", unique_key_of(summary, MIX.key).failures),
        ("missing hours", no_missing_hours_of(summary).failures),
        ("days read at first", first),
        ("days read after the merge", second),
        ("days read after nothing", third),
    ]
    return spark.createDataFrame(facts, "fact string, n bigint")


@_query(
    "refused_write",
    _with("mix delivered", "SELECT *, true AS refused FROM delivered WHERE hour(ingested_at) = 0"),
)
def _refused_write(spark, sf_dir):
    """A frame with amounts as text is refused, and the table is what it was."""
    uri = _fresh_lake(spark, "refused")
    rows = delivered_rows(spark, sf_dir)
    first_delivery = F.hour("ingested_at") == 0
    create_table(rows.filter(first_delivery), uri, MIX)
    try:
        upsert(rows.filter(~first_delivery).withColumn("power_mw", F.col("power_mw").cast("string")), uri, MIX)
        refused = False
    except SchemaMismatch:
        refused = True
    return read_table(spark, uri, MIX).withColumn("refused", F.lit(refused))


_READING = (
    "zone string, datetime_utc timestamp, event_id bigint,"
    " reading struct<power_mw: double, method: string>, parts array<struct<name: string, share: double>>"
)


@_query(
    "schema_drift",
    _with(
        "mix",
        """SELECT place, difference, wanted, found,
                  CASE counted WHEN 'all' THEN (SELECT count(*) FROM mix)
                       WHEN 'power' THEN (SELECT count(power_mw) FROM mix)
                       WHEN 'method' THEN (SELECT count(estimation_method) FROM mix) END AS rows_with_value
           FROM (VALUES
               ('zone', 'order', '1', '2', 'all'), ('datetime_utc', 'order', '2', '1', 'all'),
               ('event_id', 'missing', 'bigint', NULL, NULL),
               ('reading.power_mw', 'type', 'double', 'string', 'all'),
               ('reading.unit', 'extra', NULL, 'string', 'all'),
               ('parts.element.share', 'missing', 'double', NULL, 'power'),
               ('estimation_method', 'extra', NULL, 'string', 'method'))
               AS t(place, difference, wanted, found, counted)""",
    ),
)
def _schema_drift(spark, sf_dir):
    """Readings as another producer might send them, against the schema they should have."""
    power = F.col("power_mw")
    parts = F.when(power.isNotNull(), F.array(F.struct(F.col("source").alias("name"))))
    reading = F.struct(
        power.cast("string").alias("power_mw"), F.col("estimation_method").alias("method"), F.lit("MW").alias("unit")
    )
    sent = mix_readings(spark, sf_dir).select(
        "datetime_utc", "zone", reading.alias("reading"), parts.alias("parts"), "estimation_method"
    )
    return drift(sent, T.StructType.fromDDL(_READING))


@_query(
    "iso_times",
    """SELECT event_id, CASE event_id % 6 WHEN 0 THEN date_trunc('millisecond', ts) WHEN 1 THEN ts
                             WHEN 2 THEN date_trunc('second', ts) WHEN 3 THEN date_trunc('second', ts)
                        END AS parsed
       FROM events""",
)
def _iso_times(spark, sf_dir):
    return iso_texts(spark, sf_dir).select("event_id", parse_iso(F.col("written")).alias("parsed"))


@_query(
    "strict_groups_refused",
    """SELECT o_orderpriority AS value, count(*) AS orders, true AS refused FROM orders
       WHERE o_orderpriority = '4-NOT SPECIFIED' GROUP BY 1""",
)
def _strict_groups_refused(spark, sf_dir):
    """A grouping that leaves out one priority fails on the orders that have it, and names it."""
    known = {**PRIORITY_GROUPS, "Normal": ["3-MEDIUM"]}
    orders = table(spark, sf_dir, "orders")
    group = strict_group(F.col("o_orderpriority"), known)
    try:
        orders.groupBy(group.alias("group")).count().collect()
        refused = ""
    except PySparkException as error:
        refused = str(error)
    listed = [m for members in known.values() for m in members]
    return (
        orders.filter(~F.col("o_orderpriority").isin(listed))
        .groupBy(F.col("o_orderpriority").alias("value"))
        .agg(F.count(F.lit(1)).alias("orders"))
        .withColumn("refused", F.lit(refused).contains(F.concat(F.lit("no group lists the value: "), "value")))
    )


@_query(
    "watermark",
    _with("mix delivered", "SELECT max(ingested_at) AS ingested_at FROM delivered"),
)
def _watermark(spark, sf_dir):
    """The mark derived from the table once its state file is gone."""
    lake = _fresh_lake(spark, "watermark")
    _landed_mix(spark, sf_dir, lake)
    rebuild(spark, lake, MIX.name, "lines")
    mark = read_mark(spark, lake, MIX)
    return spark.range(1).select(
        F.lit(mark.isoformat()).cast("timestamp").alias("ingested_at")
    )


@_query("rebuild_from_bronze", _SILVER_ROWS)
def _rebuild_from_bronze(spark, sf_dir):
    lake = _fresh_lake(spark, "rebuild")
    _landed_mix(spark, sf_dir, lake)
    rebuild(spark, lake, MIX.name, "lines")
    return read_table(spark, table_path(lake, "silver", MIX.name), MIX)


@_query("stream_available_now", _SILVER_ROWS)
def _stream_available_now(spark, sf_dir):
    lake = _fresh_lake(spark, "stream")
    _landed_mix(spark, sf_dir, lake)
    load_available(spark, lake, MIX.name, "lines")
    return read_table(spark, table_path(lake, "silver", MIX.name), MIX)


@_query(
    "bronze_to_gold_mix",
    _with("zones mix delivered silver daily_mix", _DAILY_MIX_ROWS, readings="silver"),
)
def _bronze_to_gold_mix(spark, sf_dir):
    lake = _fresh_lake(spark, "gold")
    _landed_mix(spark, sf_dir, lake)
    load_new_bronze(spark, lake, MIX.name, layout="lines")
    build_daily_relative_mix(spark, lake, zones(spark, sf_dir))
    return read_table(spark, table_path(lake, "gold", DAILY_MIX.name), DAILY_MIX)


@_query(
    "bronze_to_gold_flows",
    _with(
        "zones flows net signed",
        """SELECT CASE WHEN net_import_mwh > 0 THEN 'import' ELSE 'export' END AS direction,
                  date_utc, CAST(date_utc AS TIMESTAMP) AS period_start_utc,
                  CAST(date_utc AS TIMESTAMP) + INTERVAL 1 DAY AS period_end_utc, hours_covered,
                  from_zone, f.zone_name AS from_zone_name, f.country_code AS from_country_code,
                  to_zone, t.zone_name AS to_zone_name, t.country_code AS to_country_code,
                  round(abs(net_import_mwh), 6) AS net_mwh, strftime(date_utc, '%Y') AS year
           FROM signed LEFT JOIN zones f ON f.zone = from_zone
                       LEFT JOIN zones t ON t.zone = to_zone""",
    ),
)
def _bronze_to_gold_flows(spark, sf_dir):
    lake = _fresh_lake(spark, "gold-flows")
    land(flow_responses(spark, sf_dir), table_path(lake, "bronze", FLOWS.name))
    load_new_bronze(spark, lake, FLOWS.name, layout="lines")
    build_daily_exchange(spark, lake, zones(spark, sf_dir))

    def built(contract: TableContract, direction: str) -> DataFrame:
        stored = read_table(spark, table_path(lake, "gold", contract.name), contract)
        return stored.withColumn("direction", F.lit(direction))

    return built(DAILY_IMPORTS, "import").unionByName(built(DAILY_EXPORTS, "export"))


_MIX_CHECKS = """
    SELECT 'electricity_mix_unique_key' AS check_name,
           count(*) - (SELECT count(*) FROM (SELECT DISTINCT zone, datetime_utc, source
                                             FROM silver)) AS failures
    FROM silver
    UNION ALL
    SELECT 'electricity_mix_no_missing_hours',
           date_diff('hour', min(datetime_utc), max(datetime_utc)) + 1
           - count(DISTINCT datetime_utc)
    FROM silver
    UNION ALL
    SELECT 'daily_relative_mix_sum_to_100', count(*)
    FROM (SELECT zone, date_utc FROM daily_mix GROUP BY 1, 2
          HAVING abs(coalesce(sum(percentage), 0) - 100) > 0.01)"""


@_query(
    "run_checks",
    _with(
        "zones mix delivered silver daily_mix",
        f"""SELECT check_name, failures = 0 AS passed, failures,
                  failures > 0 AND check_name <> 'electricity_mix_no_missing_hours' AS is_error
           FROM ({_MIX_CHECKS}
                 UNION ALL SELECT 'electricity_flows_unique_key', 0)""",
        readings="silver",
    ),
)
def _run_checks(spark, sf_dir):
    """The whole run on a lake with documents of both streams, and what its checks found."""
    lake = _fresh_lake(spark, "run")
    _landed_mix(spark, sf_dir, lake)
    land(flow_responses(spark, sf_dir), table_path(lake, "bronze", FLOWS.name))
    return _found(spark, run(spark, lake, zones(spark, sf_dir), layout="lines"))


def _found(spark: SparkSession, report: RunReport) -> DataFrame:
    failed = {message.split(":")[0] for message in report.errors}
    rows = [(n, r.passed, r.failures, n in failed) for n, r in report.checks.items()]
    columns = "check_name string, passed boolean, failures bigint, is_error boolean"
    return spark.createDataFrame(rows, columns)


@_query(
    "blocked_run",
    _with(
        "zones mix delivered silver daily_mix flows",
        f"""SELECT check_name, failures = 0 AS passed, failures,
                  failures > 0 AND check_name <> 'electricity_mix_no_missing_hours' AS is_error
           FROM ({_MIX_CHECKS}
                 UNION ALL
                 SELECT 'electricity_flows_unique_key', count(*) - (SELECT count(*) FROM (
                     SELECT DISTINCT zone, datetime_utc, counterpart_zone FROM flows))
                 FROM flows)
           UNION ALL
           SELECT 'not built: ' || unnest(['fr_daily_imports', 'fr_daily_exports']), false, 1, true""",
        readings="silver",
    ),
)
def _blocked_run(spark, sf_dir):
    """Silver flows with a row per order line: their key check fails and blocks both exchange
    tables, while the mix is built all the same."""
    lake = _fresh_lake(spark, "blocked")
    _landed_mix(spark, sf_dir, lake)
    load_new_bronze(spark, lake, MIX.name, layout="lines")
    lines = flow_readings(spark, sf_dir).withColumns(
        {
            "updated_at": F.lit(None).cast("timestamp"),
            "ingested_at": F.to_timestamp(F.lit("2003-01-01 00:00:00")),
        }
    )
    create_table(add_partition_columns(lines), table_path(lake, "silver", FLOWS.name), FLOWS)
    report = build_checked(spark, lake, zones(spark, sf_dir), RunReport())
    blocked = [(f"not built: {name}", False, 1, True) for name in report.not_built]
    found = _found(spark, report)
    return found.unionByName(spark.createDataFrame(blocked, found.schema))


@_query("reload_after_failure", _SILVER_ROWS)
def _reload_after_failure(spark, sf_dir):
    """A load whose mark was lost before it moved: the same documents are merged again."""
    lake = _fresh_lake(spark, "reload")
    _landed_mix(spark, sf_dir, lake)
    load_new_bronze(spark, lake, MIX.name, layout="lines")
    write_mark(spark, lake, MIX.name, datetime(2024, 1, 1, tzinfo=UTC))
    load_new_bronze(spark, lake, MIX.name, datetime(2024, 12, 31, tzinfo=UTC), "lines")
    return read_table(spark, table_path(lake, "silver", MIX.name), MIX)


@_query(
    "bronze_since",
    _with(
        "mix delivered",
        """SELECT DISTINCT zone, ingested_at, strftime(ingested_at, '%Y') AS year,
                  strftime(ingested_at, '%m') AS month, strftime(ingested_at, '%d') AS day
           FROM delivered WHERE ingested_at > TIMESTAMP '2024-01-16 00:00:00'""",
    ),
)
def _bronze_since(spark, sf_dir):
    root = _landed_mix(spark, sf_dir, _fresh_lake(spark, "since"))
    after = datetime(2024, 1, 16, tzinfo=UTC)
    found = records_since(spark, root, after, datetime(2024, 12, 31, tzinfo=UTC), layout="lines")
    return provenance(found, "surrogate://").select(
        F.get_json_object("value", "$.response.zone").alias("zone"),
        F.col("stamp").alias("ingested_at"),
        "year",
        "month",
        "day",
    )


# --- Reports ------------------------------------------------------------------------------


@_query(
    "full_months",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date_utc,
              CAST(date_trunc('month', o_orderdate) AS DATE) AS month
       FROM orders
       WHERE date_trunc('month', o_orderdate) IN (
           SELECT date_trunc('month', o_orderdate) FROM orders GROUP BY 1
           HAVING count(DISTINCT CAST(o_orderdate AS DATE)) = max(day(last_day(o_orderdate))))""",
)
def _full_months(spark, sf_dir):
    return full_months(
        table(spark, sf_dir, "orders").select(
            "o_orderkey", F.to_date("o_orderdate").alias("date_utc")
        )
    )


@_query(
    "monthly_mix_share",
    _with(
        "priorities shares",
        """SELECT month, """
        + ", ".join(
            f"""round(coalesce(sum(share) FILTER (series = '{group}'), 0), 6) AS "{group}\""""
            for group in PRIORITY_GROUPS
        )
        + " FROM shares GROUP BY month",
    ),
)
def _monthly_mix_share(spark, sf_dir):
    return monthly_mix_share(priority_energy(spark, sf_dir), PRIORITY_GROUPS)


_STACK_COLUMNS = """month, series AS "group", round(share, 6) AS share,
    round(bottom, 6) AS bottom, round(bottom + share / 2, 6) AS label_at"""


@_query(
    "monthly_stack_positions",
    _with("priorities shares stacked", f"SELECT {_STACK_COLUMNS} FROM stacked"),
)
def _monthly_stack_positions(spark, sf_dir):
    shares = monthly_group_shares(priority_energy(spark, sf_dir), PRIORITY_GROUPS)
    return stack_positions(shares, list(PRIORITY_GROUPS))


@_query(
    "last_month_labels",
    _with(
        "priorities shares stacked",
        f"""SELECT {_STACK_COLUMNS} FROM stacked
            WHERE month = (SELECT max(month) FROM stacked) AND share >= 4""",
    ),
)
def _last_month_labels(spark, sf_dir):
    shares = monthly_group_shares(priority_energy(spark, sf_dir), PRIORITY_GROUPS)
    return last_month_labels(shares, list(PRIORITY_GROUPS))


def _exchange_tables(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    net, names = daily_net_flows(flow_readings(spark, sf_dir)), zones(spark, sf_dir)
    return (
        exchange_table(net, names, "export", ordered=False),
        exchange_table(net, names, "import", ordered=False),
    )


@_query(
    "signed_exchange",
    _with(
        "flows net signed neighbours",
        """SELECT date_utc, neighbour, neighbour AS name, round(net, 6) AS net
           FROM neighbours""",
    ),
)
def _signed_exchange(spark, sf_dir):
    return signed_exchange(*_exchange_tables(spark, sf_dir))


@_query(
    "monthly_net_exchange",
    _with(
        "flows net signed neighbours monthly_net",
        "SELECT month, neighbour, name, round(net_gwh, 6) AS net_gwh FROM monthly_net",
    ),
)
def _monthly_net_exchange(spark, sf_dir):
    return monthly_net_exchange(*_exchange_tables(spark, sf_dir))


@_query(
    "top_partners",
    _with(
        "flows net signed neighbours monthly_net",
        """SELECT neighbour, name, round(sum(abs(net_gwh)), 6) AS net_gwh FROM monthly_net
           GROUP BY 1, 2 ORDER BY sum(abs(net_gwh)) DESC, 1, 2 LIMIT 8""",
    ),
)
def _top_partners(spark, sf_dir):
    return top_partners(monthly_net_exchange(*_exchange_tables(spark, sf_dir), ordered=False))


@_query(
    "table_profile",
    """SELECT 'events' AS table_name, count(*) AS row_count, min(ts) AS first_time,
              max(ts) AS last_time FROM events
       UNION ALL
       SELECT 'lineitem', count(*), min(l_shipdate), max(l_shipdate) FROM lineitem""",
)
def _table_profile(spark, sf_dir):
    def one(name: str, time_col: str) -> DataFrame:
        summary = profile(table(spark, sf_dir, name), time_col)
        return summary.select(F.lit(name).alias("table_name"), "*")

    return one("events", "ts").unionByName(one("lineitem", "l_shipdate"))


@_query("latest_rows", "SELECT * FROM events ORDER BY ts DESC, event_id DESC LIMIT 15")
def _latest_rows(spark, sf_dir):
    return latest_rows(table(spark, sf_dir, "events"), 15, "ts", ["event_id"])


def _profile_sql(name: str, columns: dict[str, str]) -> str:
    parts = [
        f"""SELECT '{name}' AS table_name, {at} AS position, '{column}' AS "column", '{kind}' AS type,
                   count(*) AS row_count, count(*) - count({column}) AS nulls,
                   {f"count(*) FILTER (isnan({column}))" if kind == "double" else "NULL"} AS not_numbers,
                   true AS distinct_close, CAST(min({column}) AS VARCHAR) AS least,
                   CAST(max({column}) AS VARCHAR) AS greatest
            FROM {name}"""
        for at, (column, kind) in enumerate(columns.items(), 1)
    ]
    return " UNION ALL ".join(parts)


@_query(
    "browse",
    _profile_sql(
        "events",
        {"event_id": "bigint", "ts": "timestamp", "user_id": "bigint", "event_type": "string",
         "value": "double", "props": "string"},
    )
    + " UNION ALL "
    + _profile_sql(
        "supplier",
        {"s_suppkey": "bigint", "s_name": "string", "s_nationkey": "int", "s_acctbal": "double"},
    ),
)
def _browse(spark, sf_dir):
    """What is in each column; the estimated number of different values is held against the exact one."""

    def one(name: str) -> DataFrame:
        df = table(spark, sf_dir, name)
        exact = df.agg(F.array(*(F.count_distinct(F.col(c)) for c in df.columns)).alias("exact"))
        about, truth = F.col("distinct_about"), F.get("exact", F.col("position") - 1)
        close = F.abs(about - truth) <= F.lit(0.06) * truth
        return (
            column_profile(df).join(F.broadcast(exact), F.lit(True))
            .withColumn("distinct_close", close).withColumn("table_name", F.lit(name))
            .select("table_name", "position", "column", "type", "row_count", "nulls", "not_numbers",
                    "distinct_close", "least", "greatest")
        )

    return one("events").unionByName(one("supplier"))

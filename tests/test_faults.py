"""States and inputs that once lost or kept rows without an error."""

import pytest
from samples import mix_document, moment, write_bronze
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from wattlake.operators.daily import exchange_table
from wattlake.operators.flatten import flatten_flows
from wattlake.operators.report import stack_positions
from wattlake.plans.gold import build_daily_relative_mix
from wattlake.plans.silver import load_new_bronze, rebuild
from wattlake.schemas import MIX, at_least_zero
from wattlake.sources import files, tables
from wattlake.sources.bronze import land
from wattlake.sources.state import mark_path, read_mark
from wattlake.streaming.silver import load_available

NOW = moment("2026-10-06 00:00:00")


def silver(spark, lake):
    return tables.read_table(spark, tables.table_path(lake, "silver", MIX.name), MIX)


class LostDriver(Exception):
    pass


def lose_driver(monkeypatch, after):
    """Publishing writes everything, and the driver is gone ``after`` calls."""
    publish, calls = tables._publish, []

    def lost(*args):
        calls.append(args)
        publish(*args)
        if len(calls) >= after:
            raise LostDriver

    monkeypatch.setattr(tables, "_publish", lost)


def test_a_first_load_is_there_whole_or_not_at_all(spark, lake, monkeypatch):
    write_bronze(lake, MIX.name, mix_document())
    with monkeypatch.context() as m:
        lose_driver(m, 1)
        with pytest.raises(LostDriver):
            load_new_bronze(spark, lake, MIX.name, NOW)
    assert not tables.table_exists(spark, tables.table_path(lake, "silver", MIX.name))
    assert load_new_bronze(spark, lake, MIX.name, NOW) == 1
    assert silver(spark, lake).count() > 0


def test_a_merge_lost_after_a_rebuild_is_repeated(spark, lake, monkeypatch):
    write_bronze(lake, MIX.name, mix_document())
    rebuild(spark, lake, MIX.name)
    write_bronze(lake, MIX.name, mix_document(7.0, "2026-10-04T09:30:00+00:00", zone="ES"))
    with monkeypatch.context() as m:
        lose_driver(m, 1)
        with pytest.raises(LostDriver):
            load_new_bronze(spark, lake, MIX.name, NOW)
    assert read_mark(spark, lake, MIX) == moment("2026-10-03 09:30:00")
    assert load_new_bronze(spark, lake, MIX.name, NOW) == 1
    assert {r["zone"] for r in silver(spark, lake).select("zone").distinct().collect()} == {"FR", "ES"}


def test_no_mark_is_derived_during_a_merge(spark, lake):
    write_bronze(lake, MIX.name, mix_document())
    load_new_bronze(spark, lake, MIX.name, NOW)
    files.delete(spark, mark_path(lake, MIX.name))
    files.write_text(spark, tables.merge_note(tables.table_path(lake, "silver", MIX.name)), "year=2026")
    with pytest.raises(tables.InterruptedMerge):
        read_mark(spark, lake, MIX)


def test_batches_are_counted_beyond_the_progress_history(spark, lake):
    for day in range(1, 6):
        write_bronze(lake, MIX.name, mix_document(ingested_at=f"2026-10-0{day}T09:30:00+00:00"))
    setting = "spark.sql.streaming.numRecentProgressUpdates"
    spark.conf.set(setting, "2")
    try:
        assert load_available(spark, lake, MIX.name, files_per_batch=1) == 5
    finally:
        spark.conf.unset(setting)


def test_nan_flows_in_no_direction(spark):
    zones = spark.createDataFrame([("A", "a", "a"), ("B", "b", "b")], "zone string, zone_name string, country_code string")
    net = spark.sql(
        "SELECT date'2026-01-01' AS date_utc, 24 AS hours_covered, 'A' AS zone, 'B' AS counterpart_zone,"
        " explode(array(double('NaN'), 5.0D, -3.0D)) AS net_import_mwh"
    )
    got = {d: [r["net_mwh"] for r in exchange_table(net, zones, d).collect()] for d in ("import", "export")}
    assert got == {"import": [5.0], "export": [3.0]}


def test_quoted_nan_is_refused(spark):
    text = (
        '{"ingested_at":"2026-10-03T09:30:00+00:00","response":{"zone":"A","history":'
        '[{"datetime":"2026-10-02T00:00:00Z","import":{"B":"NaN"},"export":{}}]}}'
    )
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        flatten_flows(spark.createDataFrame([(text,)], "value string")).collect()


def test_nan_is_not_at_least_zero(spark):
    row = spark.sql("SELECT double('NaN') AS x, 1.0D AS y")
    rule = at_least_zero("x", nullable=True), at_least_zero("y")
    assert row.select(*(F.expr(r) for r in rule)).first()[:] == (False, True)


def test_a_session_of_another_zone_is_refused(spark, lake):
    write_bronze(lake, MIX.name, mix_document())
    setting = "spark.sql.session.timeZone"
    spark.conf.set(setting, "America/Los_Angeles")
    try:
        for refused in (
            lambda: load_new_bronze(spark, lake, MIX.name, NOW),
            lambda: rebuild(spark, lake, MIX.name),
            lambda: load_available(spark, lake, MIX.name),
            lambda: build_daily_relative_mix(spark, lake, None),
        ):
            with pytest.raises(RuntimeError, match="not UTC"):
                refused()
    finally:
        spark.conf.set(setting, "UTC")


def test_a_merge_of_many_partitions_equals_one_of_few(spark, lake, monkeypatch):
    for day in range(2, 5):
        write_bronze(lake, MIX.name, mix_document(float(day), f"2026-10-0{day}T09:30:00+00:00"))
    load_new_bronze(spark, lake, MIX.name, NOW)
    monkeypatch.setattr(tables, "MOST_PATHS", 0)
    write_bronze(lake, MIX.name, mix_document(50.0, "2026-10-05T09:30:00+00:00"))
    before = silver(spark, lake).count()
    load_new_bronze(spark, lake, MIX.name, NOW)
    rows = silver(spark, lake).filter("source = 'nuclear' AND hour(datetime_utc) = 0").collect()
    assert [r["power_mw"] for r in rows] == [50.0] and silver(spark, lake).count() == before


def test_writes_at_the_same_time_restore_the_setting(spark):
    before = spark.conf.get(tables._MIN_PARTITION, None)
    first, second = tables._spread_small_writes(spark), tables._spread_small_writes(spark)
    first.__enter__(), second.__enter__()
    first.__exit__(None, None, None)
    assert spark.conf.get(tables._MIN_PARTITION) == "16k"
    second.__exit__(None, None, None)
    assert spark.conf.get(tables._MIN_PARTITION, None) == before


def test_a_null_response_is_not_landed(spark, lake):
    documents = spark.createDataFrame(
        [(None, "u", moment("2026-10-01 00:00:00"))], "response string, source_url string, ingested_at timestamp"
    )
    with pytest.raises(PySparkException):
        land(documents, lake)


def test_a_group_outside_the_stack_is_an_error(spark):
    shares = spark.createDataFrame([("2026-01", "Tidal", 4.0)], "month string, group string, share double")
    with pytest.raises(PySparkException):
        stack_positions(shares, ["Wind"]).collect()

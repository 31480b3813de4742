import json
from datetime import datetime
from pathlib import Path

import pytest
from samples import (
    flows_document,
    mix_document,
    moment,
    write_bronze,
    zone_names,
)
from pyspark.sql import functions as F

from wattlake.__main__ import main
from wattlake.operators.quality import percentages_sum_to_100
from wattlake.plans.medallion import run
from wattlake.plans.silver import STREAMS, load_new_bronze, rebuild, silver_rows
from wattlake.schemas import DAILY_EXPORTS, DAILY_IMPORTS, DAILY_MIX, FLOWS, MIX
from wattlake.sources.bronze import records_since
from wattlake.sources.state import mark_path, read_mark, write_mark
from wattlake.sources.tables import read_table, table_path, upsert
from wattlake.streaming.silver import load_available

NOW = moment("2026-10-04 00:00:00")
NEWER = "2026-10-03T21:30:00+00:00"


def silver(spark, lake, contract=MIX):
    return read_table(spark, table_path(lake, "silver", contract.name), contract)


def nuclear(spark, lake):
    df = silver(spark, lake).filter("source = 'nuclear' AND hour(datetime_utc) = 0")
    return [r["power_mw"] for r in df.collect()]


def test_only_new_files_are_loaded(spark, lake):
    write_bronze(lake, MIX.name, mix_document())
    assert load_new_bronze(spark, lake, MIX.name, NOW) == 1
    assert load_new_bronze(spark, lake, MIX.name, NOW) == 0
    write_bronze(lake, MIX.name, mix_document(12345.0, NEWER))
    assert load_new_bronze(spark, lake, MIX.name, NOW) == 1
    assert read_mark(spark, lake, MIX) == moment("2026-10-03 21:30:00")
    assert nuclear(spark, lake) == [12345.0]
    stored = json.loads(Path(mark_path(lake, MIX.name)).read_text())
    assert stored == {"ingested_at": "2026-10-03T21:30:00+00:00"}


def test_nothing_landed_is_nothing_loaded(spark, lake):
    assert load_new_bronze(spark, lake, MIX.name, NOW) == 0
    assert read_mark(spark, lake, MIX) is None


def test_the_mark_is_derived_from_the_table_when_missing(spark, lake):
    write_bronze(lake, MIX.name, mix_document())
    stream = STREAMS[MIX.name]
    rows = silver_rows(records_since(spark, stream.bronze(lake)), stream)
    upsert(rows, stream.silver(lake), MIX)
    assert read_mark(spark, lake, MIX) == moment("2026-10-03 09:30:00")


def test_marks_keep_microseconds(spark, lake):
    mark = datetime.fromisoformat("2026-10-04T15:57:26.516143+00:00")
    write_mark(spark, lake, MIX.name, mark)
    write_mark(spark, lake, MIX.name, mark)
    assert read_mark(spark, lake, MIX) == mark


def test_overlapping_documents_of_one_run_keep_the_newest(spark, lake):
    write_bronze(lake, MIX.name, mix_document(2.0, NEWER))
    write_bronze(lake, MIX.name, mix_document(1.0))
    assert load_new_bronze(spark, lake, MIX.name, NOW) == 2
    assert nuclear(spark, lake) == [2.0]
    assert silver(spark, lake).count() == 12


def test_equal_ingestion_times_go_to_the_later_file_name(spark, lake):
    write_bronze(lake, MIX.name, mix_document(1.0), suffix="_a")
    write_bronze(lake, MIX.name, mix_document(2.0), suffix="_b")
    load_new_bronze(spark, lake, MIX.name, NOW)
    assert nuclear(spark, lake) == [2.0]


def test_a_late_file_is_passed_over_by_the_batch_load(spark, lake):
    write_bronze(lake, MIX.name, mix_document(2.0, NEWER))
    load_new_bronze(spark, lake, MIX.name, NOW)
    write_bronze(lake, MIX.name, mix_document(1.0))
    assert load_new_bronze(spark, lake, MIX.name, NOW) == 0


def test_a_failed_load_keeps_the_mark_and_is_caught_up(spark, lake):
    write_bronze(lake, MIX.name, mix_document())
    load_new_bronze(spark, lake, MIX.name, NOW)
    bad = write_bronze(lake, MIX.name, mix_document(-1.0, "2026-10-03T12:00:00+00:00"))
    write_bronze(lake, MIX.name, mix_document(5.0, NEWER))
    # The newer document hides the broken one of the same hours, so make it the newest.
    worse = write_bronze(lake, MIX.name, mix_document(-1.0, "2026-10-03T22:00:00+00:00"))
    with pytest.raises(Exception, match="power_non_negative"):
        load_new_bronze(spark, lake, MIX.name, NOW)
    assert read_mark(spark, lake, MIX) == moment("2026-10-03 09:30:00")
    assert nuclear(spark, lake) == [300.0]
    for path in (bad, worse):
        path.write_text(path.read_text().replace("-1.0", "6.0"))
    assert load_new_bronze(spark, lake, MIX.name, NOW) == 3
    assert nuclear(spark, lake) == [6.0]


def test_a_name_that_differs_from_the_content_fails_the_load(spark, lake):
    path = write_bronze(lake, MIX.name, mix_document())
    path.write_text(path.read_text().replace("09:30:00", "10:30:00"))
    with pytest.raises(Exception, match="ingested_at differs from the stamp"):
        load_new_bronze(spark, lake, MIX.name, NOW)
    assert read_mark(spark, lake, MIX) is None


def test_rebuild_replaces_the_table_and_drops_the_mark(spark, lake):
    write_bronze(lake, MIX.name, mix_document(2.0, NEWER))
    load_new_bronze(spark, lake, MIX.name, NOW)
    write_bronze(lake, MIX.name, mix_document(1.0))  # late, but a rebuild sees it
    write_bronze(lake, MIX.name, mix_document(1.0, hours=5, zone="DE"), suffix="_de")
    rebuild(spark, lake, MIX.name)
    assert silver(spark, lake).count() == 12 + 20
    assert nuclear(spark, lake) != [] and 2.0 in nuclear(spark, lake)
    assert not Path(mark_path(lake, MIX.name)).exists()
    assert read_mark(spark, lake, MIX) == moment("2026-10-03 21:30:00")


@pytest.mark.parametrize("files_per_batch", [None, 1])
def test_the_stream_gives_the_same_table_in_any_order(spark, lake, files_per_batch):
    write_bronze(lake, MIX.name, mix_document(2.0, NEWER))
    write_bronze(lake, MIX.name, mix_document(1.0))
    batches = load_available(spark, lake, MIX.name, files_per_batch=files_per_batch)
    assert batches == (2 if files_per_batch else 1)
    assert nuclear(spark, lake) == [2.0]
    assert load_available(spark, lake, MIX.name) == 0
    write_bronze(lake, MIX.name, mix_document(3.0, "2026-10-03T12:00:00+00:00"))
    assert load_available(spark, lake, MIX.name) == 1  # late: seen, but older than the row
    assert nuclear(spark, lake) == [2.0] and silver(spark, lake).count() == 12


def test_a_failed_stream_is_caught_up(spark, lake):
    bad = write_bronze(lake, MIX.name, mix_document(-1.0))
    with pytest.raises(Exception, match="power_non_negative"):
        load_available(spark, lake, MIX.name)
    bad.write_text(bad.read_text().replace("-1.0", "4.0"))
    load_available(spark, lake, MIX.name)
    assert nuclear(spark, lake) == [4.0]


def gold(spark, lake, contract):
    return read_table(spark, table_path(lake, "gold", contract.name), contract)


def test_a_whole_run(spark, lake):
    write_bronze(lake, MIX.name, mix_document())
    write_bronze(lake, FLOWS.name, flows_document())
    report = run(spark, lake, zone_names(spark), NOW)
    assert report.succeeded and not report.warnings and not report.not_built
    assert report.files_loaded == {MIX.name: 1, FLOWS.name: 1}
    daily = gold(spark, lake, DAILY_MIX)
    assert percentages_sum_to_100(daily).passed
    assert daily.count() == 3 and daily.schema == DAILY_MIX.schema
    assert [r["net_mwh"] for r in gold(spark, lake, DAILY_IMPORTS).collect()] == [15.0]
    assert [r["net_mwh"] for r in gold(spark, lake, DAILY_EXPORTS).collect()] == [14.0]
    again = run(spark, lake, zone_names(spark), NOW)
    assert again.succeeded and set(again.files_loaded.values()) == {0}


def test_missing_hours_only_warn_and_wrong_sums_are_errors_after_the_build(spark, lake):
    doc = mix_document(hours=4)
    del doc["response"]["history"][1]
    for entry in doc["response"]["history"]:
        entry["mix"] = {"gas": 0.0}
    write_bronze(lake, MIX.name, doc)
    report = run(spark, lake, zone_names(spark), NOW)
    assert [w.split(":")[0] for w in report.warnings] == ["electricity_mix_no_missing_hours"]
    assert [e.split(":")[0] for e in report.errors] == ["daily_relative_mix_sum_to_100"]
    assert gold(spark, lake, DAILY_MIX).count() == 1
    assert report.not_built == [DAILY_IMPORTS.name, DAILY_EXPORTS.name]


def test_duplicate_keys_block_only_the_tables_built_from_them(spark, lake):
    write_bronze(lake, MIX.name, mix_document())
    write_bronze(lake, FLOWS.name, flows_document())
    load_new_bronze(spark, lake, MIX.name, NOW)
    copies = silver(spark, lake).withColumn("power_mw", F.lit(1.0))
    copies.write.mode("append").partitionBy("year", "month", "day").parquet(
        table_path(lake, "silver", MIX.name)
    )
    report = run(spark, lake, zone_names(spark), NOW)
    assert not report.succeeded and report.not_built == [DAILY_MIX.name]
    assert gold(spark, lake, DAILY_IMPORTS).count() == 1
    assert not Path(table_path(lake, "gold", DAILY_MIX.name)).exists()


def test_the_command_line_runs_and_rebuilds(spark, lake, tmp_path):
    zones = tmp_path / "zones.json"
    zones.write_text('{"FR": {"zoneName": "France", "countryCode": "FR"}}')
    write_bronze(lake, MIX.name, mix_document(2.0, NEWER))
    write_bronze(lake, FLOWS.name, flows_document())
    assert main([lake, str(zones)]) == 0
    write_bronze(lake, MIX.name, mix_document(1.0, hours=4))  # late: only a rebuild sees it
    assert main([lake, str(zones)]) == 0
    assert silver(spark, lake).count() == 12
    assert main([lake, str(zones), "--rebuild"]) == 0
    assert silver(spark, lake).count() == 16 and nuclear(spark, lake) == [2.0]
    assert gold(spark, lake, DAILY_MIX).first()["zone_name"] == "France"
    assert not Path(mark_path(lake, MIX.name)).exists()

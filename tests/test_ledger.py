"""Files of their own, late files, finished merges, repeated batches and kept summaries."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from samples import mix_document, moment, write_bronze

from wattlake.operators.quality import missing_hours, missing_hours_of, no_missing_hours, unique_key, unique_key_of
from wattlake.plans.silver import find_late, load_late, load_new_bronze, rebuild
from wattlake.schemas import MIX
from wattlake.sources import files, tables
from wattlake.sources.bronze import land_files, records_since
from wattlake.sources.ledger import NoLedger, ledger_path, read_ledger
from wattlake.sources.state import mark_path, read_mark, write_mark
from wattlake.sources.summaries import refresh_summary, summary_path
from wattlake.streaming.silver import checkpoint_path, load_available

NOW = moment("2026-10-08 00:00:00")
EARLY, MIDDLE, LATER = (f"2026-10-0{d}T09:30:00+00:00" for d in (3, 4, 5))


def silver(spark, lake):
    return tables.read_table(spark, tables.table_path(lake, "silver", MIX.name), MIX)


def nuclear(spark, lake):
    rows = silver(spark, lake).filter("source = 'nuclear' AND hour(datetime_utc) = 0").collect()
    return sorted((r["zone"], r["power_mw"]) for r in rows)


# --- one file per document ----------------------------------------------------------------


def responses(spark, *docs):
    rows = [(json.dumps(d["response"], indent=1), d["source_url"], moment(d["ingested_at"][:19])) for d in docs]
    return spark.createDataFrame(rows, "response string, source_url string, ingested_at timestamp")


def test_documents_become_files_and_come_back(spark, lake):
    root = f"{lake}/bronze/{MIX.name}"
    docs = [mix_document(zone="FR"), mix_document(zone="ES"), mix_document(zone="FR", ingested_at=LATER)]
    assert land_files(responses(spark, *docs).repartition(3), root) == 3
    found = sorted(Path(root).rglob("*.json"))
    assert [p.parent.name for p in found] == ["day=03", "day=03", "day=05"]
    assert all(p.name.startswith(("20261003T093000000000Z_", "20261005T093000000000Z_")) for p in found)
    assert "\n" in found[0].read_text()
    back = records_since(spark, root).collect()
    key = lambda d: (d["ingested_at"][:19], d["response"]["zone"])
    back_docs = sorted((json.loads(r["value"]) for r in back), key=key)
    assert [d["response"] for d in back_docs] == [d["response"] for d in sorted(docs, key=key)]
    assert {str(r["stamp"]) for r in back} == {"2026-10-03 09:30:00", "2026-10-05 09:30:00"}


def test_landing_twice_leaves_the_same_files(spark, lake):
    root = f"{lake}/bronze/{MIX.name}"
    for _ in range(2):
        land_files(responses(spark, mix_document()), root)
    assert len(list(Path(root).rglob("*"))) == 4  # three folders and a file
    assert land_files(responses(spark, mix_document()).limit(0), root) == 0


def test_nothing_is_left_of_a_null_response(spark, lake):
    empty = responses(spark, mix_document()).withColumn("response", F.lit(None).cast("string"))
    with pytest.raises(Exception, match="cannot land a null response"):
        land_files(empty, lake)


# --- late files ---------------------------------------------------------------------------


def names(df):
    return sorted(r["file"].rsplit("/", 1)[1] for r in df.collect())


def test_late_files_are_named_and_loaded(spark, lake):
    write_bronze(lake, MIX.name, mix_document(2.0, LATER))
    assert find_late(spark, lake, MIX.name).count() == 0  # nothing loaded yet, nothing late
    assert load_new_bronze(spark, lake, MIX.name, NOW) == 1
    late = write_bronze(lake, MIX.name, mix_document(1.0, EARLY))
    other = write_bronze(lake, MIX.name, mix_document(7.0, EARLY, zone="ES"), suffix="_es")
    newer = write_bronze(lake, MIX.name, mix_document(9.0, "2026-10-06T09:30:00+00:00", zone="DE"))
    assert names(find_late(spark, lake, MIX.name)) == sorted([late.name, other.name])
    assert load_late(spark, lake, MIX.name) == 2
    # the older document of FR gives way, the zone that was missing is there, the newer file waits
    assert nuclear(spark, lake) == [("ES", 7.0), ("FR", 2.0)]
    assert read_mark(spark, lake, MIX) == moment("2026-10-05 09:30:00")
    assert find_late(spark, lake, MIX.name).count() == 0 and load_late(spark, lake, MIX.name) == 0
    assert load_new_bronze(spark, lake, MIX.name, NOW) == 1
    assert names(read_ledger(spark, lake, MIX.name)) == sorted(p.name for p in (late, other, newer, *Path(
        lake).rglob("20261005*.json")))


def test_a_repeated_load_is_one_entry(spark, lake):
    write_bronze(lake, MIX.name, mix_document(ingested_at=MIDDLE))
    load_new_bronze(spark, lake, MIX.name, NOW)
    write_mark(spark, lake, MIX.name, moment("2026-10-01 00:00:00"))
    load_new_bronze(spark, lake, MIX.name, NOW)
    assert read_ledger(spark, lake, MIX.name).count() == 1


def test_rebuilds_and_streams_keep_the_ledger_too(spark, lake):
    write_bronze(lake, MIX.name, mix_document(2.0, LATER))
    write_bronze(lake, MIX.name, mix_document(3.0, EARLY))
    rebuild(spark, lake, MIX.name)
    assert find_late(spark, lake, MIX.name).count() == 0
    write_bronze(lake, MIX.name, mix_document(4.0, MIDDLE, zone="ES"))
    assert find_late(spark, lake, MIX.name).count() == 1
    load_available(spark, lake, MIX.name)
    assert find_late(spark, lake, MIX.name).count() == 0


def test_loads_without_a_ledger_are_not_judged(spark, lake):
    write_bronze(lake, MIX.name, mix_document())
    load_new_bronze(spark, lake, MIX.name, NOW)
    files.delete(spark, ledger_path(lake, MIX.name))
    with pytest.raises(NoLedger, match="rebuild"):
        find_late(spark, lake, MIX.name)


# --- finished merges and repeated batches -------------------------------------------------


class LostDriver(Exception):
    pass


@pytest.mark.parametrize(
    ("moves", "before_rename"), [(0, True), (1, True), (2, True), (1, False), (3, False)]
)
def test_a_merge_lost_while_publishing_is_finished(spark, lake, monkeypatch, moves, before_rename):
    """The driver is lost at each folder, before or after it is renamed; the old one is gone by then."""
    three = [mix_document(1.0), mix_document(1.0, zone="ES")]
    for doc in three:
        doc["response"]["history"] += [
            {**e, "datetime": e["datetime"].replace("10-02", day)}
            for e in doc["response"]["history"][:3] for day in ("10-01", "10-03")
        ]
    write_bronze(lake, MIX.name, three[0])
    load_new_bronze(spark, lake, MIX.name, NOW)
    new = json.loads(json.dumps(three[1]).replace("10-03T09:30", "10-04T09:30"))
    write_bronze(lake, MIX.name, new)
    move, done = files.move, []

    def lost(spark, source, target):
        if "__merge_" in source:
            if before_rename and len(done) == moves:
                raise LostDriver
            move(spark, source, target)
            done.append(target)
            if not before_rename and len(done) == moves:
                raise LostDriver
        else:
            move(spark, source, target)

    with monkeypatch.context() as m:
        m.setattr(files, "move", lost)
        with pytest.raises(LostDriver):
            load_new_bronze(spark, lake, MIX.name, NOW)
    load_new_bronze(spark, lake, MIX.name, NOW)
    uri = tables.table_path(lake, "silver", MIX.name)
    assert silver(spark, lake).count() == 72 and unique_key(silver(spark, lake), MIX.key).passed
    assert files.children(spark, f"{lake}/silver") == [MIX.name]
    assert not files.exists(spark, tables.merge_note(uri))


def test_a_mark_is_derived_after_the_merge_is_finished(spark, lake):
    write_bronze(lake, MIX.name, mix_document())
    load_new_bronze(spark, lake, MIX.name, NOW)
    files.delete(spark, mark_path(lake, MIX.name))
    uri = tables.table_path(lake, "silver", MIX.name)
    later = silver(spark, lake).withColumn("ingested_at", F.to_timestamp(F.lit("2026-10-07 00:00:00")))
    tables.stage_merge(later, uri, MIX)
    assert read_mark(spark, lake, MIX) == moment("2026-10-07 00:00:00")


def test_a_batch_is_published_once(spark, lake):
    write_bronze(lake, MIX.name, mix_document())
    load_new_bronze(spark, lake, MIX.name, NOW)
    uri = tables.table_path(lake, "silver", MIX.name)
    rows = silver(spark, lake).collect()
    batch = spark.createDataFrame(rows, MIX.schema)
    assert tables.upsert(batch.withColumn("power_mw", F.lit(5.0)), uri, MIX, batch=("a", 0))
    assert not tables.upsert(batch.withColumn("power_mw", F.lit(6.0)), uri, MIX, batch=("a", 0))
    assert {r["power_mw"] for r in silver(spark, lake).collect()} == {5.0}
    # another writer counts for itself, an empty batch counts too
    assert tables.upsert(batch.withColumn("power_mw", F.lit(7.0)), uri, MIX, batch=("b", 0))
    assert tables.upsert(batch.limit(0), uri, MIX, batch=("a", 1))
    assert tables.last_batch(spark, uri, "a") == 1 and tables.last_batch(spark, uri, "c") is None
    assert {r["power_mw"] for r in silver(spark, lake).collect()} == {7.0}


def test_a_lost_batch_keeps_its_number(spark, lake):
    write_bronze(lake, MIX.name, mix_document())
    load_new_bronze(spark, lake, MIX.name, NOW)
    uri = tables.table_path(lake, "silver", MIX.name)
    changed = silver(spark, lake).withColumn("power_mw", F.lit(8.0))
    tables.stage_merge(changed, uri, MIX, batch=("a", 4))
    assert tables.last_batch(spark, uri, "a") is None
    assert not tables.upsert(changed, uri, MIX, batch=("a", 4))  # finished first, then recognised
    assert tables.last_batch(spark, uri, "a") == 4
    assert {r["power_mw"] for r in silver(spark, lake).collect()} == {8.0}


def test_a_stream_skips_a_batch_the_checkpoint_forgot(spark, lake):
    write_bronze(lake, MIX.name, mix_document(1.0))
    assert load_available(spark, lake, MIX.name) == 1
    path = next(Path(tables.table_path(lake, "silver", MIX.name)).rglob("*.parquet"))
    before = path.stat().st_mtime_ns
    for name in ("0", ".0.crc"):
        Path(checkpoint_path(lake, MIX.name), "commits", name).unlink()
    assert load_available(spark, lake, MIX.name) == 0
    assert path.stat().st_mtime_ns == before
    write_bronze(lake, MIX.name, mix_document(2.0, LATER))
    assert load_available(spark, lake, MIX.name) == 1 and nuclear(spark, lake) == [("FR", 2.0)]


def test_small_files_are_replaced_in_one_step(spark, lake, monkeypatch):
    uri = f"{lake}/_state/x.json"
    files.write_text(spark, uri, "one")

    def refused(*_):
        raise AssertionError("the old text must not be removed first")

    monkeypatch.setattr(files, "delete", refused)
    files.write_text(spark, uri, "two")
    assert files.read_text(spark, uri) == "two" and files.children(spark, f"{lake}/_state") == ["x.json"]


# --- kept summaries -----------------------------------------------------------------------


def same_checks(spark, lake, summary):
    table = silver(spark, lake)
    assert unique_key_of(summary, MIX.key) == unique_key(table, MIX.key)
    mine, full = (sorted(r[0] for r in df.collect()) for df in (missing_hours_of(summary), missing_hours(table)))
    assert mine == full
    return no_missing_hours(table).failures


def test_summaries_follow_the_table(spark, lake):
    first = mix_document(hours=3)
    first["response"]["history"] += [
        {**e, "datetime": e["datetime"].replace("10-02", "10-05")} for e in first["response"]["history"]
    ]
    write_bronze(lake, MIX.name, first)
    load_new_bronze(spark, lake, MIX.name, NOW)
    summary, read = refresh_summary(spark, lake, MIX)
    assert read == 2 and same_checks(spark, lake, summary) == 21 + 48
    assert refresh_summary(spark, lake, MIX)[1] == 0
    # a merge into one day reads that day
    write_bronze(lake, MIX.name, mix_document(2.0, LATER, hours=20))
    load_new_bronze(spark, lake, MIX.name, NOW)
    summary, read = refresh_summary(spark, lake, MIX)
    assert read == 1 and same_checks(spark, lake, summary) == 4 + 48
    # rows that someone else wrote are seen, and so is a day that is removed
    uri = tables.table_path(lake, "silver", MIX.name)
    again = silver(spark, lake).filter("day = '05'")
    again.write.mode("append").partitionBy("year", "month", "day").parquet(uri)
    summary, read = refresh_summary(spark, lake, MIX)
    assert read == 1 and unique_key_of(summary, MIX.key).failures == 12
    same_checks(spark, lake, summary)
    files.delete(spark, f"{uri}/year=2026/month=10/day=05")
    summary, read = refresh_summary(spark, lake, MIX)
    assert read == 0 and same_checks(spark, lake, summary) == 0


def test_times_off_the_hour_are_summarised_by_position(spark, lake):
    rows = [("FR", f"2026-01-0{d} {h:02d}:{m}:00", "gas") for d in (1, 3) for h in (1, 4) for m in (15, 45)]
    df = spark.createDataFrame(rows, "zone string, t string, source string").select(
        "zone", F.to_timestamp("t").alias("datetime_utc"), "source", F.lit(1.0).alias("power_mw"),
        F.lit(None).cast("string").alias("estimation_method"), F.lit(False).alias("is_estimated"),
        F.to_timestamp("t").alias("updated_at"), F.to_timestamp("t").alias("ingested_at"),
        F.lit("2026").alias("year"), F.lit("01").alias("month"), F.substring("t", 9, 2).alias("day"),
    )
    tables.upsert(df, tables.table_path(lake, "silver", MIX.name), MIX)
    summary, _ = refresh_summary(spark, lake, MIX)
    assert same_checks(spark, lake, summary) > 0
    files.delete(spark, summary_path(lake, MIX.name))
    assert refresh_summary(spark, lake, MIX)[1] == 2

from datetime import datetime

import pytest
from samples import documents, flows_document, mix_document, moment, write_bronze
from pyspark.sql import functions as F

from wattlake.functions.times import utc
from wattlake.operators.flatten import flatten_mix
from wattlake.sources.bronze import (
    Batch,
    day_folders,
    land,
    next_batch,
    provenance,
    records_since,
)
from wattlake.sources.files import join_path
from wattlake.sources.zones import load_zones

NOW = moment("2026-10-05 12:00:00")


@pytest.fixture
def root(lake):
    for at, suffix, indent in [
        ("2026-10-03T09:30:00+00:00", "", 2),
        ("2026-10-04T15:57:26.516143+00:00", "_surrogate_20260101", None),
        ("2026-10-04T21:30:00+00:00", "", 2),
    ]:
        write_bronze(lake, "electricity_mix", mix_document(ingested_at=at), suffix, indent)
    return join_path(lake, "bronze", "electricity_mix")


def stamps(df):
    return sorted(r["s"] for r in df.select(F.col("stamp").cast("string").alias("s")).collect())


def test_everything_is_read_without_a_mark(spark, root):
    df = records_since(spark, root)
    assert stamps(df) == ["2026-10-03 09:30:00", "2026-10-04 15:57:26.516143",
                          "2026-10-04 21:30:00"]
    assert flatten_mix(df).count() == 36
    assert {(r["year"], r["month"], r["day"]) for r in df.collect()} == {
        ("2026", "10", "03"), ("2026", "10", "04")
    }


def test_only_files_strictly_after_the_mark_are_read(spark, root):
    after = datetime.fromisoformat("2026-10-04T15:57:26.516143+00:00")
    assert stamps(records_since(spark, root, after, NOW)) == ["2026-10-04 21:30:00"]
    assert stamps(records_since(spark, root, after, NOW, upto=after)) == []
    batch = next_batch(spark, root, after, NOW)
    assert batch == Batch(1, after, moment("2026-10-04 21:30:00"))
    assert next_batch(spark, root, batch.upto, NOW).files == 0


def test_only_day_folders_from_the_mark_until_today_are_listed(spark, root):
    folders = day_folders(spark, root, moment("2026-10-04 01:00:00"), NOW)
    assert [f.rsplit("/", 1)[1] for f in folders] == ["day=04"]
    assert day_folders(spark, root, moment("2026-10-05 00:00:00"), NOW) == []
    early = moment("2026-10-03 23:00:00")
    after = moment("2026-10-01 00:00:00")
    assert stamps(records_since(spark, root, after, early)) == ["2026-10-03 09:30:00"]


def test_a_missing_folder_is_empty(spark, lake):
    assert records_since(spark, lake + "/none").count() == 0
    assert next_batch(spark, lake + "/none") == Batch(0, None, None)


def test_file_names_must_start_with_a_stamp(spark, lake):
    path = write_bronze(lake, "electricity_mix", mix_document())
    path.rename(path.with_name("notes.json"))
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP"):
        records_since(spark, join_path(lake, "bronze", "electricity_mix")).collect()


def test_landing_keeps_the_response_and_files_it_by_ingestion(spark, lake):
    root = join_path(lake, "bronze", "electricity_mix")
    raw = '{"zone": "FR",\n "history": [], "note": "a \\"quoted\\" }"}'
    df = spark.createDataFrame(
        [(raw, "https://x/?zone=FR", moment("2026-10-03 09:30:00")),
         (raw, "surrogate://m/2026-01", moment("2026-10-04 00:00:00"))],
        "response string, source_url string, ingested_at timestamp",
    )
    land(df, root)
    land(df.limit(0), root)
    found = records_since(spark, root, layout="lines")
    assert found.count() == 2
    row = found.filter(F.col("day") == "03").first()
    assert row["value"] == (
        '{"ingested_at":"2026-10-03T09:30:00.000000+00:00","source_url":"https://x/?zone=FR",'
        '"response":' + raw.replace("\n", " ") + "}"
    )
    assert utc(row["stamp"]) == moment("2026-10-03 09:30:00")
    assert provenance(found, "surrogate://").count() == 1
    batch = next_batch(spark, root, moment("2026-10-03 09:30:00"), NOW, "lines")
    assert batch.files == 1 and batch.upto == moment("2026-10-04 00:00:00")


def test_the_mark_prunes_landed_batches_by_partition(spark, lake):
    root = join_path(lake, "bronze", "electricity_mix")
    df = documents(spark, flows_document()).select(
        F.col("value").alias("response"), F.lit("u").alias("source_url"),
        F.lit(moment("2026-10-03 09:30:00")).alias("ingested_at"),
    )
    land(df, root)
    found = records_since(spark, root, moment("2026-10-03 09:30:00"), NOW, layout="lines")
    plan = found._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan text" in line)
    assert "ingested" in scan.split("PartitionFilters:")[1].split("]")[0]


def test_zones_become_rows(spark, tmp_path):
    path = tmp_path / "zones.json"
    path.write_text('{\n "FR": {"zoneName": "France", "countryCode": "FR", "x": 1},\n'
                    ' "IT-NO": {"zoneName": "North Italy", "countryCode": "IT"}\n}')
    rows = load_zones(spark, str(path)).collect()
    assert sorted(map(tuple, rows)) == [("FR", "France", "FR"), ("IT-NO", "North Italy", "IT")]

import random
from datetime import timedelta

from samples import moment
from pyspark.sql import functions as F

from wattlake.operators.dedupe import deduplicate

T0 = moment("2026-01-01 00:00:00")
SCHEMA = "key string, value bigint, ingested_at timestamp, file string"


def test_the_latest_ingestion_wins(spark):
    rows = [("a", 1, T0, "f"), ("a", 2, T0 + timedelta(days=1), "f")]
    df = deduplicate(spark.createDataFrame(rows, SCHEMA), ["key"])
    assert [r["value"] for r in df.collect()] == [2]


def test_ties_go_to_the_tie_break_and_null_is_oldest(spark):
    rows = [("a", 1, T0, "f1"), ("a", 2, T0, "f2"), ("b", 3, None, "f9"), ("b", 4, T0, "f1")]
    df = deduplicate(spark.createDataFrame(rows, SCHEMA), ["key"], tie_break=["file"])
    assert {r["key"]: r["value"] for r in df.collect()} == {"a": 2, "b": 4}


def test_complete_ties_do_not_depend_on_partitioning(spark):
    rows = [("a", n, T0, "f") for n in range(50)]
    df = spark.createDataFrame(rows, SCHEMA)
    picks = {deduplicate(df.repartition(n), ["key"]).first()["value"] for n in (1, 3, 7)}
    assert picks == {49}


def test_null_keys_form_one_group(spark):
    rows = [(None, 1, T0, "f"), (None, 2, T0 + timedelta(hours=1), "f")]
    df = deduplicate(spark.createDataFrame(rows, SCHEMA), ["key"])
    assert [r["value"] for r in df.collect()] == [2]


def test_random_rows_against_plain_python_with_a_hot_key(spark):
    rng = random.Random(3)
    rows = []
    for n in range(3000):
        key = "hot" if n % 3 == 0 else f"k{rng.randrange(400)}"
        rows.append((key, n, T0 + timedelta(minutes=rng.randrange(5000)), f"f{n % 17}"))
    newest = {}
    for row in rows:
        rank = (row[2], row[3], row[1])
        if row[0] not in newest or rank > newest[row[0]][0]:
            newest[row[0]] = (rank, row[1])
    df = deduplicate(spark.createDataFrame(rows, SCHEMA), ["key"], tie_break=["file"])
    assert {r["key"]: r["value"] for r in df.collect()} == {k: v for k, (_, v) in newest.items()}


def test_copies_are_dropped_before_the_shuffle(spark):
    df = spark.range(1000).select(
        (F.col("id") % 3).alias("key"), F.col("id").alias("value"), F.lit(T0).alias("ingested_at")
    )
    plan = deduplicate(df, ["key"])._jdf.queryExecution().executedPlan().toString()
    after_exchange = plan[plan.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in after_exchange and "Partial" in after_exchange

import pytest
from samples import documents, mix_document
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattlake.operators.contract import SchemaMismatch, conform, drift, guard, violations
from wattlake.operators.flatten import add_partition_columns, flatten_flows, flatten_mix
from wattlake.schemas import DAILY_IMPORTS, DAILY_MIX, FLOWS, MIX


@pytest.fixture
def rows(spark):
    return add_partition_columns(flatten_mix(documents(spark, mix_document())))


def test_columns_are_put_in_table_order(rows):
    shuffled = rows.select(*reversed(rows.columns))
    assert conform(shuffled, MIX).columns == MIX.schema.names


@pytest.mark.parametrize(
    "change, problem",
    [
        (lambda df: df.drop("source"), "missing column source"),
        (lambda df: df.withColumn("extra", F.lit(1)), "unexpected column extra"),
        (lambda df: df.withColumn("power_mw", F.lit(1)), "power_mw is int, not double"),
    ],
)
def test_other_schemas_are_refused(rows, change, problem):
    with pytest.raises(SchemaMismatch, match=problem):
        conform(change(rows), MIX)


def test_rows_keeping_the_rules_pass_unchanged(rows):
    assert sorted(guard(rows, MIX).collect()) == sorted(rows.collect())


@pytest.mark.parametrize(
    "column, value, rule",
    [("power_mw", "-1.0", "power_non_negative"), ("zone", "NULL", "key_not_null"),
     ("source", "NULL", "key_not_null"), ("datetime_utc", "NULL", "key_not_null")],
)
def test_a_broken_rule_fails_the_job(rows, column, value, rule):
    broken = rows.withColumn(column, F.expr(f"CAST({value} AS {rows.schema[column].dataType.simpleString()})"))
    with pytest.raises(Exception, match=f"failed validation check.*{rule}"):
        guard(broken, MIX).collect()
    counts = {r["rule"]: r["violations"] for r in violations(broken, MIX).collect()}
    assert counts.pop(rule) == 12 and set(counts.values()) == {0}


@pytest.mark.parametrize(
    "contract, test, holds",
    [
        (FLOWS, "flows_non_negative", [("0D", "0D", True), ("-1D", "0D", False),
                                       ("NULL", "1D", False)]),
        (DAILY_MIX, "percentage_range", [("0D", "", True), ("100D", "", True),
                                         ("100.5D", "", False), ("NULL", "", True)]),
        (DAILY_IMPORTS, "net_positive", [("1D", "", True), ("0D", "", False),
                                         ("NULL", "", False)]),
    ],
)
def test_rules_hold_only_when_true(spark, contract, test, holds):
    for first, second, expected in holds:
        df = spark.range(1).selectExpr(
            f"CAST({first} AS double) AS import_mw", f"CAST({second or 0} AS double) AS export_mw",
            f"CAST({first} AS double) AS percentage", f"CAST({first} AS double) AS net_mwh",
            "'a' AS zone", "now() AS datetime_utc", "'b' AS counterpart_zone",
        )
        counts = {r["rule"]: r["violations"] for r in violations(df, contract).collect()}
        assert (counts[test] == 0) is expected


def test_flow_rows_fit_their_contract(spark):
    from samples import flows_document

    df = add_partition_columns(flatten_flows(documents(spark, flows_document())))
    assert guard(conform(df, FLOWS), FLOWS).count() == 6


def test_drift_names_every_difference(spark):
    df = spark.sql(
        "SELECT 1 AS b, named_struct('y', 1L, 'x', array(named_struct('k', 'a'))) AS s, map('k', 1) AS m,"
        " CAST(NULL AS INT) AS `e.f`, 'a' AS a FROM range(3)"
    )
    wanted = T.StructType.fromDDL(
        "a string, b int, s struct<x: array<struct<k: int, l: date>>, y: bigint>, m map<string, bigint>, gone date"
    )
    found = {tuple(r) for r in drift(df, wanted).collect()}
    assert found == {
        ("a", "order", "1", "4", 3), ("b", "order", "2", "1", 3), ("m", "order", "4", "3", 3),
        ("s", "order", "3", "2", 3),
        ("s.x.element.k", "type", "int", "string", 3), ("s.x.element.l", "missing", "date", None, 3),
        ("s.x", "order", "1", "2", 3), ("s.y", "order", "2", "1", 3), ("m.value", "type", "bigint", "int", 3),
        ("e.f", "extra", None, "int", 0), ("gone", "missing", "date", None, None),
    }


def test_a_frame_that_conforms_has_no_drift(spark):
    assert drift(spark.createDataFrame([], MIX.schema), MIX.schema).count() == 0
    with pytest.raises(SchemaMismatch, match="two columns"):
        drift(spark.sql("SELECT 1 AS a, 2 AS a"), MIX.schema)

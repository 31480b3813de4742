from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from wattlake.operators.report import (
    browse,
    column_profile,
    full_months,
    last_month_labels,
    latest_rows,
    monthly_group_shares,
    monthly_mix_share,
    monthly_net_exchange,
    signed_exchange,
    stack_positions,
    top_partners,
)
from wattlake.schemas import SOURCE_GROUPS

JAN = [date(2026, 1, 1) + timedelta(days=n) for n in range(31)]
FEB = [date(2026, 2, 1) + timedelta(days=n) for n in range(28)]


def daily(spark, rows):
    return spark.createDataFrame(rows, "date_utc date, source string, energy_mwh double")


def test_a_month_with_a_missing_day_is_left_out(spark):
    rows = [(d, "gas", 1.0) for d in JAN + FEB[:-1] for _ in (1, 2)]
    df = full_months(daily(spark, rows))
    assert df.count() == 62
    assert {r["month"] for r in df.collect()} == {date(2026, 1, 1)}


def test_monthly_shares_have_every_group(spark):
    rows = [(d, s, e) for d in JAN for s, e in (("nuclear", 6.0), ("coal", 1.0), ("oil", 1.0))]
    rows += [(d, "gas", 2.0) for d in FEB]
    wide = monthly_mix_share(daily(spark, rows)).collect()
    assert [r["month"].month for r in wide] == [1, 2]
    assert wide[0].asDict() == {
        "month": date(2026, 1, 1), "Nuclear": 75.0, "Hydro": 0.0, "Wind": 0.0, "Solar": 0.0,
        "Gas": 0.0, "Coal & oil": 25.0, "Other": 0.0,
    }
    assert wide[1]["Gas"] == 100.0


def test_a_source_in_no_group_fails_and_null_does_not(spark):
    rows = [(d, "fusion", 1.0) for d in JAN]
    with pytest.raises(Exception, match="no group lists the value: fusion"):
        monthly_group_shares(daily(spark, rows)).collect()
    rows = [(d, None, 1.0) for d in JAN]
    assert monthly_group_shares(daily(spark, rows)).first()["group"] is None


def test_a_month_without_energy_has_undefined_shares(spark):
    share = monthly_group_shares(daily(spark, [(d, "gas", 0.0) for d in JAN])).first()["share"]
    assert share != share


def test_bands_are_stacked_in_group_order(spark):
    order = list(SOURCE_GROUPS)
    shares = spark.createDataFrame(
        [(JAN[0], "Gas", 3.0), (JAN[0], "Nuclear", 60.0), (JAN[0], "Hydro", 37.0),
         (FEB[0], "Gas", 3.0), (FEB[0], "Wind", 97.0)],
        "month date, group string, share double",
    )
    rows = {(r["month"].month, r["group"]): (r["bottom"], r["label_at"])
            for r in stack_positions(shares, order).collect()}
    assert rows == {(1, "Nuclear"): (0.0, 30.0), (1, "Hydro"): (60.0, 78.5),
                    (1, "Gas"): (97.0, 98.5), (2, "Wind"): (0.0, 48.5), (2, "Gas"): (97.0, 98.5)}
    labels = last_month_labels(shares, order).collect()
    assert [(r["group"], r["label_at"]) for r in labels] == [("Wind", 48.5)]


def test_monthly_reports_read_their_input_once(spark, tmp_path):
    daily(spark, [(d, "gas", 1.0) for d in JAN]).write.parquet(str(tmp_path / "d"))
    shares = monthly_group_shares(spark.read.parquet(str(tmp_path / "d")))
    labels = last_month_labels(shares, list(SOURCE_GROUPS))
    assert labels._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert [r["group"] for r in labels.collect()] == ["Gas"]


def test_a_source_of_an_incomplete_month_needs_no_group(spark):
    rows = [(d, "gas", 1.0) for d in JAN] + [(FEB[0], "fusion", 1.0)]
    assert [r["group"] for r in monthly_group_shares(daily(spark, rows)).collect()] == ["Gas"]


def exchange(spark, rows, here, there):
    columns = f"date_utc date, {here}_zone string, {there}_zone string, {there}_zone_name string"
    return spark.createDataFrame(rows, columns + ", net_mwh double")


def test_monthly_net_exchange_and_ranking(spark):
    exports = exchange(spark, [(d, "FR", "DE", "Germany", 1000.0) for d in JAN[:20]], "from", "to")
    imports = exchange(
        spark,
        [(d, "FR", "DE", "Germany", 500.0) for d in JAN[20:]]
        + [(d, "FR", "ES", "Spain", 2000.0) for d in JAN[:9]],
        "to", "from",
    )
    assert signed_exchange(exports, imports).count() == 40
    monthly = monthly_net_exchange(exports, imports)
    # Every day of the month occurs, though with no single neighbour on all of them.
    assert [(r["neighbour"], r["net_gwh"]) for r in monthly.collect()] == [
        ("DE", 14.5), ("ES", -18.0)
    ]
    ranked = top_partners(monthly).collect()
    assert [(r["neighbour"], r["net_gwh"]) for r in ranked] == [("ES", 18.0), ("DE", 14.5)]
    assert top_partners(monthly, 1).count() == 1


def test_browsing_a_table(spark):
    df = daily(spark, [(d, "gas", float(n)) for n, d in enumerate(JAN)])
    seen = browse(df)
    assert (seen.rows, seen.first_time, seen.last_time) == (31, JAN[0], JAN[-1])
    assert seen.columns == {"date_utc": "date", "source": "string", "energy_mwh": "double"}
    assert [r["date_utc"] for r in seen.latest] == JAN[-15:]
    assert browse(df.select("source")).first_time is None
    newest = latest_rows(df, 2, tie_break=["source"])._jdf.queryExecution().executedPlan()
    assert "TakeOrderedAndProject" in newest.toString()


def test_columns_of_any_type_have_a_profile(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1, double('NaN'), array(1, 2), map('a', 1), 'x', date'2026-01-01'),"
        " (2, 1.5D, array(1), map('b', 2), NULL, NULL), (2, NULL, NULL, NULL, 'a', date'2025-01-01')"
        " AS t(i, d, l, m, s, day)"
    ).withColumn("v", F.parse_json(F.lit('{"a": 1}'))).toDF("i", "d", "l", "m", "s", "s", "v")
    got = [tuple(r) for r in column_profile(df).collect()]
    assert got == [
        (1, "i", "int", 3, 0, None, 2, "1", "2"),
        (2, "d", "double", 3, 1, 1, 2, "1.5", "NaN"),
        (3, "l", "array<int>", 3, 1, None, 2, "[1]", "[1, 2]"),
        (4, "m", "map<string,int>", 3, 1, None, None, None, None),
        (5, "s", "string", 3, 1, None, 2, "a", "x"),
        (6, "s", "date", 3, 1, None, 2, "2025-01-01", "2026-01-01"),
        (7, "v", "variant", 3, 0, None, None, None, None),
    ]
    empty = column_profile(df.limit(0)).collect()
    assert [(r["row_count"], r["nulls"], r["least"]) for r in empty] == [(0, 0, None)] * 7

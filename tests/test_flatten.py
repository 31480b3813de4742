import random

import pytest
from samples import document, documents, flows_document, mix_document, mix_entry

from wattlake.operators.flatten import (
    add_partition_columns,
    flatten_flows,
    flatten_mix,
)
from wattlake.schemas import FLOWS, MIX


def power(df):
    return {(r["datetime_utc"].hour, r["source"]): r["power_mw"] for r in df.collect()}


def test_the_entries_of_a_mix_become_rows(spark):
    df = flatten_mix(documents(spark, mix_document()))
    assert df.columns == MIX.data_columns
    wanted = {f.name: f.dataType for f in MIX.schema}
    assert all(f.dataType == wanted[f.name] for f in df.schema)
    assert df.select(*MIX.key).distinct().count() == df.count() == 12
    sources = {r["source"] for r in df.collect()}
    assert sources == {"nuclear", "wind", "hydro_storage_charge", "hydro_storage_discharge"}


def test_mix_values_may_be_number_null_or_object(spark):
    mix = {
        "wind": None, "gas": 12, "big": 1e5, "pumped hydro": {"charge": None, "dis charge": 5},
        "empty": {}, "odd": {"": 1.5}, "flows": {"exports": 1},
    }
    df = flatten_mix(documents(spark, document([mix_entry(0, mix)])))
    assert power(df) == {
        (0, "wind"): None, (0, "gas"): 12.0, (0, "big"): 100000.0,
        (0, "pumped_hydro_charge"): None, (0, "pumped_hydro_dis_charge"): 5.0,
        (0, "odd_"): 1.5,
    }


@pytest.mark.parametrize("value", ["12", True, [1.0], {"charge": "12"}, {"charge": {"x": 1}}])
def test_mix_refuses_what_is_not_a_number(spark, value):
    with pytest.raises(Exception, match="not a number"):
        flatten_mix(documents(spark, document([mix_entry(0, {"gas": value})]))).collect()


@pytest.mark.parametrize(
    "method, estimated",
    [(None, False), ("MEASURED", False), ("SURROGATE", True), ("ESTIMATED_X", True)],
)
def test_only_a_named_method_other_than_measured_is_an_estimate(spark, method, estimated):
    df = flatten_mix(documents(spark, document([mix_entry(0, {"gas": 1.0}, method)])))
    assert df.first()["is_estimated"] is estimated


@pytest.mark.parametrize("path", ["ingested_at", "response", "zone", "history", "datetime", "mix"])
def test_a_missing_mandatory_field_fails(spark, path):
    doc = document([mix_entry(0, {"gas": 1.0})])
    for holder in (doc, doc["response"], doc["response"]["history"][0]):
        if path in holder:
            del holder[path]
            break
    with pytest.raises(Exception, match="missing"):
        flatten_mix(documents(spark, doc)).collect()


def test_empty_text_is_no_timestamp_and_malformed_text_fails(spark):
    entry = {**mix_entry(0, {"gas": 1.0}), "updatedAt": ""}
    assert flatten_mix(documents(spark, document([entry]))).first()["updated_at"] is None
    entry["updatedAt"] = "yesterday"
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        flatten_mix(documents(spark, document([entry]))).collect()


def test_malformed_documents_fail(spark):
    with pytest.raises(Exception, match="MALFORMED"):
        flatten_mix(spark.createDataFrame([('{"response": [',)], "value string")).collect()


def test_no_history_gives_no_rows(spark):
    assert flatten_mix(documents(spark, document([]))).count() == 0


def test_a_neighbour_in_either_map_gets_a_row_each_hour(spark):
    df = flatten_flows(documents(spark, flows_document()))
    assert df.columns == FLOWS.data_columns
    rows = {(r["datetime_utc"].hour, r["counterpart_zone"]): (r["import_mw"], r["export_mw"])
            for r in df.collect()}
    assert rows == {
        (6, "BE"): (12.5, 0), (6, "CH"): (4, 9), (7, "BE"): (7.5, 2), (7, "CH"): (0, 1.5),
        (8, "BE"): (0, 3), (8, "CH"): (0.5, 8),
    }


@pytest.mark.parametrize(
    "exchange, expected",
    [
        ({"import": {"A": 1.0}, "export": {"B": 2.0}}, {"A": (1.0, 0.0), "B": (0.0, 2.0)}),
        ({"import": {"A": None}, "export": {}}, {"A": (None, 0.0)}),
        ({"import": None, "export": {"A": 3.0}}, {"A": (0.0, 3.0)}),
        ({"export": {"A": 3}}, {"A": (0.0, 3.0)}),
        ({"import": None, "export": None}, {}),
        ({}, {}),
    ],
)
def test_an_absent_neighbour_is_zero_and_a_stored_null_stays(spark, exchange, expected):
    entry = {"datetime": "2026-10-02T00:00:00.000Z", **exchange}
    rows = flatten_flows(documents(spark, document([entry]))).collect()
    assert {r["counterpart_zone"]: (r["import_mw"], r["export_mw"]) for r in rows} == expected


def test_flows_refuse_quoted_numbers(spark):
    entry = {"datetime": "2026-10-02T00:00:00.000Z", "import": {"A": "12"}, "export": {}}
    with pytest.raises(Exception, match="MALFORMED"):
        flatten_flows(documents(spark, document([entry]))).collect()


def test_random_documents_against_plain_python(spark):
    rng = random.Random(7)
    docs, expected = [], []
    for n in range(40):
        history = []
        for hour in range(rng.randrange(5)):
            mix = {}
            for name in rng.sample(["wind", "hydro storage", "gas x", "flows", "coal"], 3):
                mix[name] = rng.choice([None, 3, 2.5, {}, {"charge": 1.5, "discharge": None}])
            history.append(mix_entry(hour, mix))
            for name, value in mix.items():
                if name == "flows":
                    continue
                parts = (
                    {f"{name}_{k}": v for k, v in value.items()}
                    if isinstance(value, dict) else {name: value}
                )
                expected += [(f"Z{n}", hour, k.replace(" ", "_"), v) for k, v in parts.items()]
        docs.append(document(history, zone=f"Z{n}"))
    rows = flatten_mix(documents(spark, *docs)).collect()
    found = [(r["zone"], r["datetime_utc"].hour, r["source"], r["power_mw"]) for r in rows]
    assert sorted(found, key=str) == sorted(
        [(*e[:3], None if e[3] is None else float(e[3])) for e in expected], key=str
    )


def test_partition_columns_are_zero_padded_strings(spark):
    df = add_partition_columns(flatten_mix(documents(spark, mix_document())))
    row = df.first()
    assert (row["year"], row["month"], row["day"]) == ("2026", "10", "02")


@pytest.mark.parametrize(
    "flatten, doc", [(flatten_mix, mix_document()), (flatten_flows, flows_document())]
)
def test_documents_are_parsed_once_and_not_copied_to_their_entries(spark, tmp_path, flatten, doc):
    documents(spark, doc).write.text(str(tmp_path / "docs"))
    df = flatten(spark.read.text(str(tmp_path / "docs")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1
    explode = next(line for line in plan.splitlines() if "posexplode" in line)
    assert "document" not in explode

"""Small documents, zones and Bronze files for the tests."""

import json
from datetime import UTC, datetime
from pathlib import Path


def moment(text: str) -> datetime:
    return datetime.fromisoformat(text).replace(tzinfo=UTC)


def document(history, zone="FR", ingested_at="2026-10-03T09:30:00+00:00", url="https://x/y"):
    return {
        "ingested_at": ingested_at,
        "source_url": url,
        "response": {
            "zone": zone, "temporalGranularity": "hourly", "unit": "MW", "history": history,
        },
    }


def mix_entry(hour, mix, method="MEASURED", day="2026-10-02"):
    return {
        "datetime": f"{day}T{hour:02d}:00:00.000Z",
        "updatedAt": f"{day}T23:30:00.123456+00:00",
        "estimationMethod": method,
        "breakdownType": "normal",
        "mix": mix,
    }


def mix_document(nuclear=300.0, ingested_at="2026-10-03T09:30:00+00:00", hours=3, zone="FR"):
    mix = {
        "nuclear": nuclear,
        "wind": 100.0,
        "hydro storage": {"charge": 50.0, "discharge": None},
        "flows": {"imports": 1.0, "exports": 2.0},
    }
    later = {**mix, "nuclear": 300.0}
    history = [mix_entry(h, mix if h == 0 else later) for h in range(hours)]
    return document(history, zone=zone, ingested_at=ingested_at)


def flows_document(ingested_at="2026-10-03T09:30:00+00:00"):
    """A morning in which BE delivers 15 MWh net and CH takes 14."""
    hours = {
        6: ({"BE": 12.5, "CH": 4.0}, {"CH": 9.0}),
        7: ({"BE": 7.5}, {"BE": 2.0, "CH": 1.5}),
        8: ({"CH": 0.5}, {"BE": 3.0, "CH": 8.0}),
    }
    history = [
        {
            "datetime": f"2026-10-02T{h:02d}:00:00.000Z", "updatedAt": None,
            "import": bought, "export": sold,
        }
        for h, (bought, sold) in hours.items()
    ]
    return document(history, ingested_at=ingested_at)


def write_bronze(lake, stream, doc, suffix="", indent=2):
    """One document as one file, named and filed by its ingestion time."""
    at = datetime.fromisoformat(doc["ingested_at"])
    folder = Path(lake, "bronze", stream, f"year={at:%Y}", f"month={at:%m}", f"day={at:%d}")
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / f"{at:%Y%m%dT%H%M%S%fZ}{suffix}.json"
    path.write_text(json.dumps(doc, indent=indent))
    return path


def documents(spark, *docs):
    return spark.createDataFrame([(json.dumps(d),) for d in docs], "value string")


def zone_names(spark):
    rows = [("FR", "France", "FR"), ("ES", "Spain", "ES"), ("DE", "Germany", "DE")]
    return spark.createDataFrame(rows, "zone string, zone_name string, country_code string")

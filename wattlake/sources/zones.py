"""The zone dimension: one JSON object keyed by zone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def zones_from(documents: DataFrame, text: str = "value") -> DataFrame:
    parsed = F.from_json(
        text, "map<string,struct<zoneName:string,countryCode:string>>", {"mode": "FAILFAST"}
    )
    return documents.select(F.explode(parsed).alias("zone", "info")).select(
        "zone",
        F.col("info.zoneName").alias("zone_name"),
        F.col("info.countryCode").alias("country_code"),
    )


def load_zones(spark: SparkSession, uri: str) -> DataFrame:
    return zones_from(spark.read.text(uri, wholetext=True))

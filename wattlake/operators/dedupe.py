"""Keep the newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def deduplicate(
    df: DataFrame,
    key: Sequence[str],
    order_by: str = "ingested_at",
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """The row with the greatest ``order_by`` per key; nulls are oldest.

    Ties go to ``tie_break`` and then to the remaining columns, so a recomputed task picks the
    same row.  Filtering row_number() = 1 lets Spark keep one row per key in every map task
    before the shuffle, so a key with very many copies sends only one row per task.
    """
    unordered = (T.MapType, T.VariantType)
    rest = [
        field.name
        for field in df.schema
        if field.name not in {*key, order_by, *tie_break}
        and not isinstance(field.dataType, unordered)
    ]
    newest_first = [F.desc_nulls_last(c) for c in [order_by, *tie_break, *rest]]
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*newest_first))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")

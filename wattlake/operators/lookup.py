"""Joining descriptive columns from a dimension.

No broadcast hint is given: Spark broadcasts the dimension when its size statistic is below
spark.sql.autoBroadcastJoinThreshold and otherwise runs a shuffled join that adaptive execution
splits on skewed keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_dimension(
    df: DataFrame, dimension: DataFrame, key: str, columns: Sequence[str], prefix: str = ""
) -> DataFrame:
    """Left join on ``prefix + key``, every dimension column under the same prefix."""
    named = dimension.select(*(F.col(c).alias(f"{prefix}{c}") for c in [key, *columns]))
    return df.join(named, f"{prefix}{key}", "left")

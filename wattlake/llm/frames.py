"""Adding computed columns to a table in Arrow batches of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from wattlake.llm.words import release_memory, sliced

Compute = Callable[[pa.RecordBatch], dict]


def with_computed(
    df: DataFrame,
    text: str,
    fields: Sequence[StructField],
    compute: Compute,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """``df`` (or its ``keep`` columns) with the columns that ``compute`` returns for each slice.

    A computed column takes the place of a column of the same name.
    """
    new = {field.name for field in fields}
    kept = [f for f in df.schema.fields if f.name not in new and (keep is None or f.name in keep)]
    schema = StructType([*kept, *fields])
    arrow = to_arrow_schema(schema)
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            release_memory()
            for part in sliced(batch, text):
                values = compute(part)
                columns = [part.column(name) for name in names]
                columns += [
                    v if isinstance(v, pa.Array) else pa.array(v, arrow.field(k).type)
                    for k, v in ((field.name, values[field.name]) for field in fields)
                ]
                yield pa.RecordBatch.from_arrays(
                    [c.cast(f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow
                )

    return df.mapInArrow(run, schema)


def exchange_buckets(df: DataFrame, bytes_each: int = 8 << 20) -> int:
    """How many groups to deal hashes of a table into, so that a group has about the same size
    whatever the size of the table; at least the session's shuffle partitions."""
    spark = SparkSession.getActiveSession() or df.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    # an estimate that Spark does not have is its largest number
    known = estimate if estimate < 1 << 60 else 0
    return max(partitions, min(known // bytes_each, 1 << 20))

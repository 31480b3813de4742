"""Folding a table into one small state: per task, then in groups, then on the driver."""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterator
from functools import reduce
from typing import Any

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.llm.words import release_memory
from wattlake.session import scratch_path

_STATE = pa.schema([("part", pa.int64()), ("state", pa.binary())])


def _row(part: int, state: Any) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"part": [part], "state": [pickle.dumps(state)]}, schema=_STATE)


def fold(
    rows: DataFrame,
    add: Callable[[Any, pa.RecordBatch], Any],
    merge: Callable[[Any, Any], Any],
    fan: int = 16,
) -> Any:
    """The state of a whole table, None for an empty one.

    ``add(state, batch)`` takes one more Arrow batch into a state (None at first) and ``merge``
    joins two of them.  A task leaves one state, whatever it has read; these are written to the
    shared folder, merged ``fan`` at a time on the executors until ``fan`` are left, and only
    those come to the driver.  ``merge`` sees states in the order of the tasks.
    """
    spark = rows.sparkSession

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            release_memory()
            if batch.num_rows:
                state = add(state, batch)
        if state is not None:
            yield _row(TaskContext.get().partitionId(), state)

    def together(group: pa.Table) -> pa.Table:
        group = group.sort_by("part")
        state = reduce(merge, map(pickle.loads, group.column("state").to_pylist()))
        return pa.Table.from_batches([_row(group.column("part")[0].as_py(), state)])

    path = scratch_path(spark, "partials")
    rows.mapInArrow(per_task, "part long, state binary").write.parquet(path)
    states = spark.read.schema("part long, state binary").parquet(path)
    count = states.count()
    # tasks without rows leave no state, so part numbers are counted anew by their order
    while count > fan:
        count = math.ceil(count / fan)
        states = states.groupBy(F.pmod("part", F.lit(count)).alias("part_group")).applyInArrow(
            together, "part long, state binary"
        )
    found = sorted(states.collect(), key=lambda row: row["part"])
    return reduce(merge, (pickle.loads(row["state"]) for row in found)) if found else None

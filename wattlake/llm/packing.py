"""Best-fit packing into sequences of several permitted lengths.

Documents (in pieces, where longer than the longest sequence) go to bins, longest first, each into
the open bin with the least room that still takes it.  Where none does, the bin size of least cost
per token is opened; at the end each bin shrinks to the smallest permitted size that holds its
contents.  Several lower limits for opened bins are tried and the cheapest packing is taken, so
that all sizes are optimised together.

Pieces of one length are interchangeable.  Spark counts pieces by length, the driver packs those
counts (at most one per token of the longest sequence, however many documents there are), and
each piece finds its place by its number among the pieces of its length.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattlake.session import scratch_path

SIZES = (256, 512, 1024, 2048, 4096)


def bin_cost(size: int, per_bin: float = 16.0, quadratic: float = 1 / 32768) -> float:
    """What a sequence costs: its tokens, attention over them, and something per sequence."""
    return per_bin + size + quadratic * size * size


@dataclass(frozen=True)
class Bins:
    """``count`` bins of equal contents: (length, how many of it) from the longest down."""

    count: int
    size: int
    contents: tuple[tuple[int, int], ...]


def _pack_counts(counts: dict[int, int], sizes: Sequence[int], least: int, cost) -> list[Bins]:
    room: dict[int, list[tuple[int, tuple]]] = {}
    rooms: list[int] = []
    closed: list[tuple[int, int, tuple]] = []

    def put(free: int, count: int, contents: tuple, size: int) -> None:
        if count:
            if free not in room:
                room[free] = []
                insort(rooms, free)
            room[free].append((count, contents, size))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                free = rooms[at]
                count, contents, size = room[free].pop()
                if not room[free]:
                    del room[free], rooms[at]
            else:
                fitting = [s for s in sizes if s >= max(length, least)]
                free = size = min(fitting, key=lambda s: (cost(s) / s, s))
                count, contents = -(-left // (size // length)), ()
            each = free // length
            full = min(count, left // each)
            put(free - each * length, full, (*contents, (length, each)), size)
            left -= full * each
            count -= full
            if count and left:  # fewer than fill one bin more
                put(free - left * length, 1, (*contents, (length, left)), size)
                left, count = 0, count - 1
            put(free, count, contents, size)
    for free, groups in room.items():
        closed += [(count, size - free, contents) for count, contents, size in groups]
    return [
        Bins(count, min(s for s in sizes if s >= used), contents)
        for count, used, contents in sorted(closed)
    ]


def pack_counts(counts: dict[int, int], sizes: Sequence[int] = SIZES, cost=bin_cost) -> list[Bins]:
    """The cheapest of the packings that open no bin under one of the sizes, then shrink."""
    packings = [_pack_counts(counts, sizes, least, cost) for least in sizes]
    return min(packings, key=lambda bins: sum(b.count * cost(b.size) for b in bins))


def _places(bins: list[Bins]) -> dict[int, tuple[np.ndarray, ...]]:
    """Per length: from which number on pieces go to a group of bins, and where in it."""
    rows: dict[int, list[tuple[int, ...]]] = {}
    used: dict[int, int] = {}
    first_bin = 0
    for group in bins:
        offset = 0
        for length, each in group.contents:
            start = used.get(length, 0)
            rows.setdefault(length, []).append((start, each, first_bin, offset, group.size))
            used[length] = start + each * group.count
            offset += each * length
        first_bin += group.count
    return {length: tuple(np.array(x, np.int64) for x in zip(*r, strict=True)) for length, r in rows.items()}


def counted_tokens(docs: DataFrame, id_col: str, length) -> DataFrame:
    """(id, __n), written to the shared folder, as it is read several times and counting is what
    costs."""
    counted = docs.select(F.col(id_col), F.coalesce(length.cast("long"), F.lit(0)).alias("__n"))
    path = scratch_path(docs.sparkSession, "token-counts")
    counted.write.parquet(path)
    return docs.sparkSession.read.schema(counted.schema).parquet(path)


def pieces_of(counted: DataFrame, id_col: str, longest: int) -> DataFrame:
    """(id, piece, start, n_tokens): documents cut to at most ``longest`` tokens."""
    last = F.greatest(F.ceil(F.col("__n") / longest) - 1, F.lit(0))
    return counted.select(
        F.col(id_col), "__n", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))).alias("piece")
    ).select(
        id_col,
        "piece",
        (F.col("piece") * longest).alias("start"),
        F.least(F.lit(longest).cast("long"), F.col("__n") - F.col("piece") * longest).cast("int").alias("n_tokens"),
    )


def count_words(text_col: str):
    return F.regexp_count(F.col(text_col), F.lit(r"[^\x20\x09-\x0D]+"))


def pack_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    length=None,
    text_col: str = "text",
    sizes: Sequence[int] = SIZES,
    cost=bin_cost,
) -> DataFrame:
    """One row per piece: id, ``piece``, ``start`` (its first token in the document),
    ``n_tokens``, ``bin_id``, ``bin_size`` and ``bin_offset`` (its first token in the bin).

    ``length`` is a column expression for a document's tokens, by default its words; give a
    tokenizer's counts (``pieces.encode_and_decode``) to pack for its model.  A document
    longer than the largest size is cut into pieces of that size and a rest.  Nothing is dropped:
    a document without tokens (null length or text, no words) has one row of 0 tokens, which is in
    no bin.  Repeated rows, and rows with a null id, are packed one by one.  Other columns of
    ``docs`` are not returned.  An empty table gives an empty table.
    """
    spark = docs.sparkSession
    sizes = sorted(sizes)
    counted = counted_tokens(docs, id_col, count_words(text_col) if length is None else length)
    pieces = pieces_of(counted, id_col, sizes[-1])
    # pieces of a frequent length are numbered in many parts, so that none is a task's own
    parts = max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    pieces = pieces.withColumn("__part", F.pmod(F.xxhash64(id_col, "piece"), F.lit(parts)))
    tally = pieces.filter("n_tokens > 0").groupBy("n_tokens", "__part").agg(F.count(F.lit(1)).alias("__count"))
    counts = {r["n_tokens"]: r["n"] for r in tally.groupBy("n_tokens").agg(F.sum("__count").alias("n")).collect()}
    places = _places(pack_counts(counts, sizes, cost))
    earlier = Window.partitionBy("n_tokens").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = tally.select(
        "n_tokens", "__part", F.coalesce(F.sum("__count").over(earlier), F.lit(0)).alias("__before")
    )
    within = Window.partitionBy("n_tokens", "__part").orderBy(id_col, "piece")
    numbered = (
        pieces.withColumn("__row", F.row_number().over(within))
        .join(before, ["n_tokens", "__part"], "left")
        .select(
            id_col, "piece", "start", "n_tokens",
            (F.coalesce("__before", F.lit(0)) + F.col("__row") - 1).alias("__number"),
        )
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.asarray(batch.column("n_tokens"), np.int64)
            numbers = np.asarray(batch.column("__number"), np.int64)
            found = np.zeros((3, len(lengths)), np.int64)
            for length in np.unique(lengths[lengths > 0]):
                mine = np.flatnonzero(lengths == length)
                start, each, first_bin, offset, size = places[int(length)]
                group = np.searchsorted(start, numbers[mine], "right") - 1
                nth = numbers[mine] - start[group]
                found[0, mine] = first_bin[group] + nth // each[group]
                found[1, mine] = size[group]
                found[2, mine] = offset[group] + nth % each[group] * length
            none = lengths == 0
            columns = [batch.column(n) for n in (id_col, "piece", "start", "n_tokens")] + [
                pa.array(found[0], pa.int64(), mask=none),
                pa.array(found[1].astype(np.int32), pa.int32(), mask=none),
                pa.array(found[2].astype(np.int32), pa.int32(), mask=none),
            ]
            yield pa.RecordBatch.from_arrays(
                columns, names=[id_col, "piece", "start", "n_tokens", "bin_id", "bin_size", "bin_offset"]
            )

    schema = pieces.select(id_col, "piece", "start", "n_tokens").schema
    for name, kind in (("bin_id", "long"), ("bin_size", "integer"), ("bin_offset", "integer")):
        schema = schema.add(name, kind)
    return numbered.mapInArrow(place, schema)

"""Exact top-k by inner product, pruned by statistics of vector segments.

A vector is cut into segments, and of each only the mean and the standard deviation are looked at.
For two vectors, the inner product of a segment of length w is at most
``w * (mean_x * mean_y + dev_x * dev_y)`` (Cauchy-Schwarz on the deviations), which is the same as
a lower bound of their distance.  With few segments the bound is cheap and loose, with many it is
close: candidates are bounded coarse to fine, and only those that may still reach a query's k-th
best score are scored exactly.  Bounds and scores of many queries at once are matrix products.

Queries and candidates are dealt into blocks; a task gets one block of either and returns k rows
per query at most.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattlake.session import scratch_path

LEVELS = (1, 4, 16)
_BEST = pa.schema([("ask", pa.int64()), ("vec", pa.int64()), ("score", pa.int64())])


def segment_statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Rows whose inner products are upper bounds of those of the rows of ``x``."""
    columns = []
    for part in np.array_split(np.arange(x.shape[1]), segments):
        if len(part):
            mean, dev = x[:, part].mean(1), x[:, part].std(1)
            columns += [mean * math.sqrt(len(part)), dev * math.sqrt(len(part))]
    return np.stack(columns, 1) if columns else np.zeros((len(x), 1))


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of integer-valued rows, as 64-bit integers.

    Doubles are exact below 2**53; larger ones go by integers of any size, and one that does not fit
    into 64 bits is an error.
    """
    top = np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * max(1, q.shape[-1])
    if top < 2**53:
        return (q * x).sum(-1).astype(np.int64)
    big = (_integers(q) * _integers(x)).sum(-1)
    if any(not -(1 << 63) <= int(v) < 1 << 63 for v in big.flat):
        raise OverflowError("an inner product does not fit into 64 bits")
    return big.astype(np.int64)


def _integers(x: np.ndarray) -> np.ndarray:
    return np.frompyfunc(int, 1, 1)(x)


#: Queries bounded together, and so the size of the matrices of bounds.
TILE = 64


def block_top_k(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int
) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per query (by its place) the ids and scores of the k best candidates but itself, ties to
    smaller ids.

    ``ids`` must be ascending; several candidates may share an id, and of those that have the id and
    the vector of a query one is the query itself.
    """
    with np.errstate(over="ignore"):
        longest = np.sqrt((vectors**2).sum(1).max(initial=0))
        slack = 1e-9 * np.sqrt((queries**2).sum(1)) * longest + 1e-6
    if not np.isfinite(slack).all():
        raise OverflowError("vectors are too long for bounds of their inner products")
    largest = np.abs(vectors).max(initial=0)
    levels = [
        (segment_statistics(queries, n), segment_statistics(vectors, n))
        for n in sorted({min(level, queries.shape[1]) for level in LEVELS})
    ]
    result = []
    for a in range(0, len(queries), TILE):
        tile = np.arange(a, min(a + TILE, len(queries)))
        # the coarsest bounds say where to look first, and the scores there what is to be beaten
        coarse = levels[0][0][tile] @ levels[0][1].T
        for row, at in enumerate(tile):
            same = np.arange(*np.searchsorted(ids, [query_ids[at], query_ids[at] + 1]))
            coarse[row, same[(vectors[same] == queries[at]).all(1)][:1]] = -np.inf
        others = np.isfinite(coarse)
        take = np.minimum(k, others.sum(1))
        beat = np.full(len(tile), np.inf)
        for row, n in enumerate(take):
            if n:
                first = np.argpartition(-coarse[row], n - 1)[:n]
                beat[row] = exact_scores(queries[tile[row]], vectors[first]).min() - slack[tile[row]]
        columns, alive = np.arange(len(ids)), others & (coarse >= beat[:, None])
        for of_queries, of_vectors in levels[1:]:
            some = alive.any(0)
            columns, alive = columns[some], alive[:, some]
            alive &= of_queries[tile] @ of_vectors[columns].T >= beat[:, None]
        # whole numbers below 2**53 are exact as doubles, in whatever order they are summed up; where
        # bounds leave most pairs, one product of all is cheaper than the pairs one by one
        whole = largest * np.abs(queries[tile]).max(initial=0) * queries.shape[1] < 2**53
        table = queries[tile] @ vectors[columns].T if whole and 8 * alive.sum() > alive.size else None
        for row, n in enumerate(take):
            if not n:
                continue
            left = np.flatnonzero(alive[row])
            if table is not None:
                scores = table[row, left]
                left = left[scores >= -np.partition(-scores, n - 1)[n - 1]]
                scores = table[row, left].astype(np.int64)
            else:
                scores = exact_scores(queries[tile[row]], vectors[columns[left]])
            best = np.lexsort((ids[columns[left]], -scores))[:n]
            result.append((np.full(len(best), tile[row]), ids[columns[left[best]]], scores[best]))
    return result


def _matrix(table: pa.Table, width: int) -> np.ndarray:
    rows = table.column("vector").combine_chunks()
    lengths = np.diff(rows.offsets.to_numpy())
    x = np.zeros((table.num_rows, width))
    flat = rows.flatten().to_numpy(zero_copy_only=False)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    x[np.repeat(np.arange(len(lengths)), lengths), place] = flat
    return x


def _width(*tables: pa.Table) -> int:
    return max([1, *(len(v) for t in tables for v in t.column("vector"))])


def top_k(
    vectors: DataFrame,
    is_query,
    id_col: str = "vec_id",
    vector_col: str = "vector",
    k: int = 20,
    block: int = 16384,
    query_block: int = 1024,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query row the ``k`` best of all other rows.

    ``vectors`` has integer-valued components as doubles; the score is their inner product, which
    is exact; one beyond 64 bits, or a vector too long to bound, is an error.  ``is_query`` is a
    condition on its columns.  Ties go to the smaller id.  Rows with a null id, a null vector or a
    component that is null or not finite take no part.  Vectors of different lengths are compared
    as if the shorter ended in zeros.  Rows that share an id are different rows: each query row is
    answered for itself, and only that row is no candidate of it.  Other columns are not returned.
    """
    usable = (
        F.col(id_col).isNotNull()
        & F.col(vector_col).isNotNull()
        & F.forall(
            vector_col,
            lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")),
        )
    )
    rows = vectors.filter(F.coalesce(usable, F.lit(False))).select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    )
    total = rows.agg(
        F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col("asks"), 1)).alias("queries")
    ).first()
    blocks = max(1, math.ceil(total["rows"] / block))
    query_blocks = max(1, math.ceil(total["queries"] / query_block))
    # equal query rows are asked once, under a number that the shared folder keeps
    path = scratch_path(vectors.sparkSession, "asked")
    (
        rows.filter("asks").groupBy("id", "vector").agg(F.count(F.lit(1)).alias("times"))
        .withColumn("ask", F.monotonically_increasing_id()).write.parquet(path)
    )
    once = vectors.sparkSession.read.parquet(path)
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = once.select(
        (F.pmod(F.xxhash64("id"), F.lit(query_blocks))).cast("int").alias("qb"), numbers(blocks).alias("cb"),
        "id", "vector", "ask",
    )
    offered = rows.select(
        numbers(query_blocks).alias("qb"),
        F.pmod(F.xxhash64("id", "vector"), F.lit(blocks)).cast("int").alias("cb"),
        "id", "vector",
    )

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _BEST.empty_table()
        right = right.sort_by("id")
        width = _width(left, right)
        found = block_top_k(
            left.column("id").to_numpy(), _matrix(left, width),
            right.column("id").to_numpy(), _matrix(right, width), k,
        )
        if not found:
            return _BEST.empty_table()
        place, vecs, scores = (np.concatenate(x) for x in zip(*found, strict=True))
        return pa.table([left.column("ask").to_numpy()[place], vecs, scores], schema=_BEST)

    near = (
        asked.groupBy("qb", "cb").cogroup(offered.groupBy("qb", "cb"))
        .applyInArrow(best, "ask long, vec long, score long")
    )
    order = Window.partitionBy("ask").orderBy(F.desc("score"), "vec")
    ranked = near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    # one row per query and rank and row of the table that asks it
    return ranked.join(once.select("ask", F.col("id").alias("query_id"), "times"), "ask").select(
        "query_id", "rank", F.col("vec").alias("vec_id"), "score", F.explode(F.sequence(F.lit(1), "times")).alias("time")
    ).drop("time")

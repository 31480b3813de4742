"""Nearest neighbours by inner product from a forest of random-projection trees.

A tree splits the vectors at the medians of random projections; its levels share orthonormal
directions (Hyvönen et al., "Fast nearest neighbor search through sparse random projections and
voting"), so that a vector's place in a tree takes one small matrix product.  The trees are fitted
on a bounded sample; every row of the table is then placed in a leaf of every tree.

A query walks all trees at once: one priority queue holds the branches not yet taken, by the squared
distance to them along the directions crossed, and the nearest branch of whichever tree is taken
next.  How many leaves a query may open is not guessed: for some probe queries the true neighbours
are computed over the whole table, and the budget is the number of leaves that finds the wanted share
of them.  The rows of the opened leaves are scored exactly.

So that the largest inner products are the nearest vectors, all vectors are scaled to at most length 1
and given one more component that makes it exactly 1.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from wattlake.llm.vectors import matrix, usable
from wattlake.llm.words import releasing_pair, release_memory
from wattlake.session import scratch_path

#: Cells of a matrix of scores, and components of a block of vectors, held at once.
_CELLS = 1 << 21
_FOUND = pa.schema([("query", pa.int64()), ("row", pa.int64()), ("vec", pa.int64()), ("score", pa.float64())])


@dataclass(frozen=True)
class Forest:
    """Directions per tree and level, and split points per tree and inner node, root first."""

    directions: np.ndarray
    splits: np.ndarray
    scale: float

    @property
    def trees(self) -> int:
        return self.directions.shape[0]

    @property
    def depth(self) -> int:
        return self.directions.shape[1]

    @property
    def leaves(self) -> int:
        return 1 << self.depth

    def _projected(self, lifted: np.ndarray) -> np.ndarray:
        """(tree, row, level)."""
        return np.matmul(lifted, self.directions.transpose(0, 2, 1))

    def lifted(self, x: np.ndarray) -> np.ndarray:
        y = x / self.scale
        return np.column_stack([y, np.sqrt(np.maximum(0.0, 1.0 - (y * y).sum(1)))])

    def asked(self, x: np.ndarray) -> np.ndarray:
        """Queries of length 1; the length of a query does not change which rows are its best."""
        y = x / np.abs(x).max(1, initial=0, keepdims=True)
        y /= np.sqrt((y * y).sum(1, keepdims=True))
        return np.column_stack([y, np.zeros(len(y))])

    def places(self, x: np.ndarray) -> np.ndarray:
        """(row, tree): the leaf of every vector in every tree."""
        p = self._projected(self.lifted(x))
        node = np.zeros(p.shape[:2], np.int64)
        for level in range(self.depth):
            split = np.take_along_axis(self.splits, (1 << level) - 1 + node, 1)
            node = 2 * node + (p[:, :, level] > split)
        return node.T.astype(np.int32)

    def opened(self, queries: np.ndarray, sizes: np.ndarray, budget: int, least: int) -> Iterator[list[tuple[int, int]]]:
        """The leaves (tree, leaf) that each query opens, nearest first, out of one queue for all trees.

        ``budget`` leaves, and more until those of one tree hold ``least`` rows.
        """
        p = self._projected(self.asked(queries))
        splits, depth = self.splits.tolist(), self.depth
        counts = sizes.tolist()
        for query in range(len(queries)):
            at = p[:, query].tolist()
            queue = [(0.0, tree, 0, 0) for tree in range(self.trees)]
            found: list[tuple[int, int]] = []
            seen = [0] * self.trees
            while queue and (len(found) < budget or max(seen) < least):
                far, tree, level, node = heapq.heappop(queue)
                while level < depth:
                    margin = at[tree][level] - splits[tree][(1 << level) - 1 + node]
                    level += 1
                    node = 2 * node + (margin > 0)
                    heapq.heappush(queue, (far + margin * margin, tree, level, node ^ 1))
                found.append((tree, node))
                seen[tree] += counts[tree][node]
            yield found


def fit_forest(sample: np.ndarray, scale: float, trees: int, depth: int, seed: int = 1) -> Forest:
    """Trees over the different vectors of a sample; a node without any splits at 0."""
    pick = np.random.default_rng(seed)
    width = sample.shape[1] + 1
    depth = min(depth, width)
    directions = np.zeros((trees, depth, width))
    for tree in range(trees):
        directions[tree] = np.linalg.qr(pick.standard_normal((width, depth)))[0].T
    splits = np.zeros((trees, (1 << depth) - 1))
    bare = Forest(directions, splits, scale)
    p = bare._projected(bare.lifted(np.unique(sample, axis=0)))
    for tree in range(trees):
        node = np.zeros(p.shape[1], np.int64)
        for level in range(depth):
            order = np.lexsort((p[tree, :, level], node))
            ends = np.searchsorted(node[order], np.arange((1 << level) + 1))
            middle = ends[:-1] + (np.diff(ends) - 1) // 2
            some = np.diff(ends) > 0
            first = (1 << level) - 1
            splits[tree, first : first + (1 << level)][some] = p[tree, order[middle[some]], level]
            node = 2 * node + (p[tree, :, level] > splits[tree, first + node])
    return Forest(directions, splits, scale)


def exact_scores(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products of rows with rows, each summed up in the same order, so that equal vectors
    have equal scores; one that is not a number counts as the least."""
    with np.errstate(over="ignore", invalid="ignore"):
        score = np.einsum("nd,nd->n", x, y)
    return np.where(np.isnan(score), -np.inf, score)


def leaf_best(
    queries: np.ndarray, own: np.ndarray, rows: np.ndarray, vecs: np.ndarray, vectors: np.ndarray,
    best: tuple[np.ndarray, np.ndarray], k: int,
) -> tuple[np.ndarray, np.ndarray]:
    """The best ``k`` of those known and the rows of one leaf: (scores, places in the leaf's block).

    ``best`` has -inf and -1 where there are fewer.  A matrix product rules out what cannot be
    among the best, with room for its rounding; the others are scored one by one.
    """
    scores, places = best
    with np.errstate(over="ignore", invalid="ignore"):
        table = queries @ vectors[rows].T
        longest = np.sqrt((vectors[rows] ** 2).sum(1).max(initial=0))
        slack = 1e-12 * np.sqrt((queries**2).sum(1)) * longest
    bar = scores[:, -1]
    if len(rows) > k:
        # with the own row among them there may be one less
        bar = np.maximum(bar, -np.partition(-table, k, 1)[:, k])
    with np.errstate(invalid="ignore"):
        keep = ~(table < (bar - slack)[:, None])
    q, r = np.nonzero(keep & (own[:, None] != rows[None, :]))
    step = max(1, _CELLS // max(1, queries.shape[1]))
    exact = np.concatenate(
        [np.zeros(0)] + [exact_scores(queries[q[a : a + step]], vectors[rows[r[a : a + step]]]) for a in range(0, len(q), step)]
    )
    known_q, known = np.nonzero(places >= 0)
    q = np.concatenate([known_q, q])
    exact = np.concatenate([scores[known_q, known], exact])
    found = np.concatenate([places[known_q, known], rows[r]])
    order = np.lexsort((found, vecs[found], -exact, q))
    q, exact, found = q[order], exact[order], found[order]
    rank = np.arange(len(q)) - np.searchsorted(q, np.arange(len(queries)))[q]
    top = rank < k
    scores, places = np.full((len(queries), k), -np.inf), np.full((len(queries), k), -1)
    scores[q[top], rank[top]], places[q[top], rank[top]] = exact[top], found[top]
    return scores, places


def block_best(asking: pa.Table, offered: pa.Table, tree_leaf: str, k: int, width: int) -> pa.Table:
    """The best rows of a block for each query, out of the leaves that the query has opened."""
    offered = offered.sort_by([(tree_leaf, "ascending")])
    vectors = matrix(offered.column("vector"), width)
    vecs, handles = offered.column("id").to_numpy(), offered.column("row").to_numpy()
    leaf_of = offered.column(tree_leaf).to_numpy()
    queries = matrix(asking.column("vector"), width)
    query_rows = asking.column("row").to_numpy()
    opened = asking.column("leaves").combine_chunks()
    who = np.repeat(np.arange(asking.num_rows), np.diff(opened.offsets.to_numpy()))
    what = opened.flatten().to_numpy()
    by_leaf = np.argsort(what, kind="stable")
    who, what = who[by_leaf], what[by_leaf]
    place = {int(h): i for i, h in enumerate(handles)}
    own = np.array([place.get(int(h), -1) for h in query_rows])
    scores = np.full((len(queries), k), -np.inf)
    places = np.full((len(queries), k), -1)
    for leaf in np.unique(what):
        rows = np.arange(*np.searchsorted(leaf_of, [leaf, leaf + 1]))
        asks = who[slice(*np.searchsorted(what, [leaf, leaf + 1]))]
        if not len(rows):
            continue
        step = max(1, _CELLS // len(rows))
        for a in range(0, len(asks), step):
            some = asks[a : a + step]
            scores[some], places[some] = leaf_best(
                queries[some], own[some], rows, vecs, vectors, (scores[some], places[some]), k
            )
    q, at = np.nonzero(places >= 0)
    found = places[q, at]
    return pa.table([query_rows[q], handles[found], vecs[found], scores[q, at]], schema=_FOUND)


def _probed(stored: DataFrame, probes: pa.Table, k: int, width: int) -> list:
    """For each probe the leaves of its true ``k`` best rows, found over the whole table."""
    asked, asked_rows = matrix(probes.column("vector"), width), probes.column("row").to_numpy()

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            release_memory()
            vectors = matrix(batch.column("vector"), width)
            vecs, handles = batch.column("id").to_numpy(), batch.column("row").to_numpy()
            place = {int(h): i for i, h in enumerate(handles)}
            own = np.array([place.get(int(h), -1) for h in asked_rows])
            state = np.full((len(asked), k), -np.inf), np.full((len(asked), k), -1)
            step = max(k + 1, _CELLS // max(width, len(asked)))
            for a in range(0, len(vectors), step):
                rows = np.arange(a, min(a + step, len(vectors)))
                state = leaf_best(asked, own, rows, vecs, vectors, state, k)
            q, at = np.nonzero(state[1] >= 0)
            found = state[1][q, at]
            yield pa.RecordBatch.from_pydict({
                "probe": asked_rows[q], "score": state[0][q, at], "id": vecs[found], "row": handles[found],
                "leaves": batch.column("leaves").take(pa.array(found)),
            })

    order = Window.partitionBy("probe").orderBy(F.desc("score"), "id", "row")
    return (
        stored.select("row", "id", "vector", "leaves")
        .mapInArrow(best, "probe long, score double, id long, row long, leaves array<int>")
        .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        .select("probe", "leaves").collect()
    )


def needed_budget(forest: Forest, probes: pa.Table, neighbours: list, sizes: np.ndarray, recall: float, width: int) -> int:
    """The fewest leaves per query in which the probes find the wanted share of their neighbours."""
    opened = forest.opened(matrix(probes.column("vector"), width), sizes, forest.trees * forest.leaves, 0)
    turns = {}
    for row, leaves in zip(probes.column("row").to_pylist(), opened, strict=True):
        turns[row] = {leaf: turn for turn, leaf in enumerate(leaves, 1)}
    first = sorted(
        min(turns[found["probe"]][(tree, leaf)] for tree, leaf in enumerate(found["leaves"])) for found in neighbours
    )
    return first[min(len(first), math.ceil(recall * len(first))) - 1] if first else 1


def nearest(
    vectors: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 20,
    trees: int = 4,
    leaf_rows: int = 256,
    recall: float = 0.95,
    sample_rows: int = 16_384,
    probe_rows: int = 128,
    block_rows: int = 32_768,
    block_queries: int = 8_192,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query row the ``k`` largest inner products found
    among all other rows, ties to the smaller id.

    ``is_query`` is a condition on the table's columns.  Scores are exact, in doubles.  The trees are
    fitted on ``sample_rows`` rows (those with the least hashes), all rows are placed in them, and
    ``probe_rows`` queries, chosen alike, say how many leaves to open for the wanted ``recall``.  A
    query opens more until it has ``k`` other rows, or all.

    Rows with a null id, and vectors that are null, empty, all zeros or hold components that are null
    or not finite take no part; a shorter vector is taken as if it ended in zeros.  Every row is a
    candidate for each query but itself, also where rows share an id or a vector; rows that share a
    query id are answered each for itself.  Products beyond the range of doubles are infinite.
    Other columns are not returned.
    """
    spark = vectors.sparkSession
    length = F.aggregate(vector_col, F.lit(0.0), lambda total, x: F.greatest(total, F.abs(x.cast("double"))))
    rows = vectors.filter(F.col(id_col).isNotNull() & usable(F.col(vector_col))).select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"), length.alias("largest"),
    ).filter("largest > 0")
    squares = F.aggregate(
        "vector", F.lit(0.0), lambda total, x: total + F.pow(x.cast("double") / F.col("largest"), F.lit(2.0))
    )
    known = rows.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("asks").alias("queries"), F.max("largest").alias("component"),
        F.max(F.col("largest") * F.sqrt(squares)).alias("longest"), F.max(F.size("vector")).alias("width"),
    ).first()
    columns = "query_id long, rank int, vec_id long, score double"
    if not known["queries"]:
        return spark.createDataFrame([], columns)
    width = known["width"]
    # rounding may not make a vector longer than 1; lengths beyond doubles are cut
    scale = min(known["longest"] * (1 + 1e-12), 1.7e308)

    some = max(256, min(sample_rows, (32 << 20) // (8 * width)))
    by_hash = [F.xxhash64("id", "vector"), F.col("id")]
    sample = rows.select("id", "vector").orderBy(*by_hash).limit(some).toArrow()
    depth = max(0, min(round(math.log2(known["rows"] / leaf_rows)), int(math.log2(max(1, sample.num_rows / 8)))))
    forest = fit_forest(matrix(sample.column("vector"), width), scale, trees, depth)

    path = scratch_path(spark, "forest")
    _placed(rows.select("id", "vector", "asks"), forest, width).withColumn(
        "row", F.monotonically_increasing_id()
    ).write.parquet(f"{path}/placed")
    stored = spark.read.parquet(f"{path}/placed")

    in_leaf = stored.select(F.posexplode("leaves").alias("tree", "leaf")).groupBy("tree", "leaf").count()
    sizes = np.zeros((trees, forest.leaves), np.int64)
    # trees times leaves at most, which the sample bounds
    for found in in_leaf.collect():
        sizes[found["tree"], found["leaf"]] = found["count"]

    asking = stored.filter("asks").select("row", "id", "vector")
    probes = asking.orderBy(*by_hash, "row").limit(probe_rows).toArrow()
    budget = needed_budget(forest, probes, _probed(stored, probes, k, width), sizes, recall, width)

    blocks = leaf_blocks(sizes, max(1024, min(block_rows, (16 << 20) // (8 * width))))
    visits = _visits(asking, forest, sizes, blocks, budget, k + 1, width)
    visits.write.parquet(f"{path}/visits")
    visits = spark.read.parquet(f"{path}/visits")
    # a block that many queries ask goes to several tasks, each with some of the queries
    asked = visits.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / block_queries).cast("int").alias("turns"))
    part_of = spark.createDataFrame(
        [(t, leaf, *map(int, blocks[t, leaf])) for t in range(trees) for leaf in range(forest.leaves)],
        "tree int, leaf int, first int, parts int",
    )
    offered = (
        stored.select("row", "id", "vector", F.posexplode("leaves").alias("tree", "leaf"))
        .join(F.broadcast(part_of), ["tree", "leaf"])
        .withColumn("block", F.col("first") + F.pmod(F.xxhash64("row"), F.col("parts")).cast("int"))
        .join(asked, "block")
        .withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("turns") - 1)))
        .select("block", "turn", "row", "id", "vector", "leaf")
    )
    turned = visits.join(asked, "block").withColumn(
        "turn", F.pmod(F.xxhash64("row"), F.col("turns")).cast("int")
    ).select("block", "turn", "row", "vector", "leaves")

    def best(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _FOUND.empty_table()
        return block_best(left, right, "leaf", k, width)

    found = (
        turned.groupBy("block", "turn").cogroup(offered.groupBy("block", "turn"))
        .applyInArrow(releasing_pair(best), "query long, row long, vec long, score double")
        .dropDuplicates(["query", "row"])
    )
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec", "row")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    names = asking.select(F.col("row").alias("query"), F.col("id").alias("query_id"))
    return ranked.join(names, "query").select("query_id", "rank", F.col("vec").alias("vec_id"), "score")


def _placed(rows: DataFrame, forest: Forest, width: int) -> DataFrame:
    """The rows with their leaf in every tree."""
    schema = StructType([*rows.schema.fields, StructField("leaves", ArrayType(IntegerType()))])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            release_memory()
            leaves = forest.places(matrix(batch.column("vector"), width))
            offsets = pa.array(np.arange(len(leaves) + 1) * forest.trees, pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(leaves.ravel(), pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "leaves"])

    return rows.mapInArrow(place, schema)


def leaf_blocks(sizes: np.ndarray, most: int) -> np.ndarray:
    """(tree, leaf, 2): the first block of a leaf's rows and how many blocks they are dealt over.

    Neighbouring leaves share a block up to ``most`` rows; a leaf with more, as many copies of a
    vector make it, has several to itself.
    """
    result = np.ones((*sizes.shape, 2), np.int64)
    block, held = 0, 0
    for tree in range(len(sizes)):
        for leaf, size in enumerate(sizes[tree].tolist()):
            if held and held + size > most:
                block, held = block + 1, 0
            parts = max(1, math.ceil(size / most))
            result[tree, leaf] = block, parts
            if parts > 1:
                block, held = block + parts, 0
            else:
                held += size
        block, held = block + 1, 0
    return result


def _visits(
    asking: DataFrame, forest: Forest, sizes: np.ndarray, blocks: np.ndarray, budget: int, least: int, width: int
) -> DataFrame:
    """(block, row, vector, leaves): which leaves of which blocks each query opens."""
    kinds = {f.name: f for f in asking.schema.fields}
    schema = StructType([
        StructField("block", IntegerType()), StructField("row", LongType()), kinds["vector"],
        StructField("leaves", ArrayType(IntegerType())),
    ])

    def open_leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                block, place, leaves = [], [], []
                found = forest.opened(matrix(batch.column("vector"), width), sizes, budget, least)
                for i, opened in enumerate(found):
                    by_block: dict[int, list[int]] = {}
                    for tree, leaf in opened:
                        first, parts = blocks[tree, leaf]
                        for b in range(first, first + parts):
                            by_block.setdefault(b, []).append(leaf)
                    block += by_block
                    leaves += by_block.values()
                    place += [i] * len(by_block)
                picked = batch.take(pa.array(place, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block, pa.int32()), picked.column("row"), picked.column("vector"),
                     pa.array(leaves, pa.list_(pa.int32()))],
                    names=["block", "row", "vector", "leaves"],
                )

    return asking.mapInArrow(open_leaves, schema)

"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


from wattlake.session import scratch_path


def are_stars(edges: DataFrame) -> bool:
    """Whether no node at the larger end of an edge (a, b) has any other edge."""
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("a").alias("node"), F.lit(1).alias("larger")),
        F.struct(F.col("b").alias("node"), F.lit(0).alias("larger")),
    )).alias("end"))
    seen = ends.groupBy("end.node").agg(F.count(F.lit(1)).alias("n"), F.sum("end.larger").alias("larger"))
    return seen.filter("larger > 0 AND n > 1").count() == 0


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (a, b: longs), component the smallest node.

    An edge with a null end is none.  The number of rounds grows with the logarithm of the longest
    path; there is no limit to it.

    Alternates two steps that keep the components (Kiveris et al., "Connected components in
    MapReduce and beyond"): every node links its larger neighbours, then its smaller ones, to the
    smallest node it knows, until every edge points to the smallest node of its component.  The
    edges of each round are written to the shared folder, so a lost executor costs one round at
    most.  So are the smallest nodes that each node knows: the edges are then joined with a table
    whose real size Spark knows, which is sent to all tasks while it is small, and beyond that a
    plain join, in which adaptive execution splits a node with very many neighbours.
    """
    spark = edges.sparkSession
    root = scratch_path(spark, "components")

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{root}/{name}")
        return spark.read.schema(df.schema).parquet(f"{root}/{name}")

    current = written(
        edges.select(F.greatest("a", "b").cast("long").alias("a"), F.least("a", "b").cast("long").alias("b"))
        .filter("a > b").distinct(),
        "edges-0",
    )
    step = 0
    while not are_stars(current):
        step += 1
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = written(
            both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("m", "a")), f"least-{step}"
        )
        large = written(
            both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .filter("a > b").distinct(),
            f"large-{step}",
        )
        small_least = written(large.groupBy("a").agg(F.min("b").alias("m")), f"small-{step}")
        small = (
            large.join(small_least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(small_least.select("a", F.col("m").alias("b")))
            .filter("a > b").distinct()
        )
        current = written(small, f"edges-{step}")
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )

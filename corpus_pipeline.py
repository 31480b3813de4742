"""From documents to packed training sequences, in five stages.

Each stage takes what the one before it kept.  ``run`` applies all of them to ``documents``; every
stage's result is written to the shared folder and read again by the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.llm import ngram_join, packing, passages, quality_model, quality_rules
from wattlake.session import scratch_path

#: The classifier is fitted anew, so no SQL gives these rows; tests compare with brute force.
ORACLE_SQL = None


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def _masked(docs: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """``docs`` with names that no operator uses, for all columns but those it needs; :func:`_unmasked`
    gives them back, so that a column named like a result is not taken for one."""
    return docs.toDF(*(c if c in keep else f"__column{i}" for i, c in enumerate(docs.columns)))


def _unmasked(masked: DataFrame, docs: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    return masked.select(
        *(F.col(c if c in keep else f"__column{i}").alias(c) for i, c in enumerate(docs.columns))
    )


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine takes for good ones, with their columns as they are."""
    keep = ("doc_id", "text", "n_chars")
    masked = _masked(docs, keep)
    model = quality_model.fit_quality_model(masked, _labels(spark, sf_dir))
    scored = quality_model.score_quality(masked, model)
    return _unmasked(scored.filter(F.col("predicted") == 1), docs, keep)


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither a base rule nor a risk-controlled cutoff rejects, with their columns
    as they are; without a column ``lang`` all are one stratum."""
    keep = ("doc_id", "text", "lang")
    masked = _masked(docs, keep)
    if "lang" not in docs.columns:
        masked = masked.withColumn("lang", F.lit(None).cast("string"))
    judged = quality_rules.apply_quality_rules(masked, _labels(spark, sf_dir))
    return _unmasked(judged.filter("kept"), docs, keep)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id, of several the first by
    text.  Rows that share an id but not a similar text are different documents; rows without an
    id stay."""
    known = docs.filter(F.col("doc_id").isNotNull())
    unknown = docs.filter(F.col("doc_id").isNull())
    if known.groupBy("doc_id").count().filter(F.col("count") > 1).isEmpty():
        groups = ngram_join.jaccard_components(known)
        chosen = groups.filter(F.col("component_id") == F.col("doc_id")).select("doc_id")
        return known.join(chosen, "doc_id", "left_semi").select(*docs.columns).unionByName(unknown)
    # a number for each different id and text, in their order, stands for the id
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    # a struct of nothing cannot be written
    others = F.struct(*(rest or [F.lit(0).alias("__nothing")]))
    different = known.groupBy("doc_id", "text").agg(F.min(others).alias("__rest"))
    path = scratch_path(spark, "repeated-ids")
    different.sort("doc_id", "text").withColumn("__row", F.monotonically_increasing_id()).write.parquet(path)
    numbered = spark.read.parquet(path)
    groups = ngram_join.jaccard_components(numbered, id_col="__row")
    chosen = groups.filter(F.col("component_id") == F.col("__row")).select("__row")
    kept = numbered.join(chosen, "__row", "left_semi").select("doc_id", "text", "__rest.*")
    return kept.select(*docs.columns).unionByName(unknown)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that a document with a smaller id has; ``n_chars``, where there is one,
    follows a text that is cut, and all other columns stay as they are."""
    keep = ("doc_id", "text", "n_chars")
    cut = passages.remove_repeated_passages(_masked(docs, keep))
    if "n_chars" in docs.columns:
        size = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
        cut = cut.withColumn("n_chars", size)
    return _unmasked(cut, docs, keep)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in which training sequence; other columns than these
    places are not returned."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_filter),
    ("ngram_jaccard", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("best_fit_packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root = scratch_path(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{root}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

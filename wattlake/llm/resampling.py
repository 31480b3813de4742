"""Importance resampling towards a target: documents drawn by how much they look like it.

Words and runs of words are hashed into buckets.  What a bucket gains is the logarithm of how much
more frequent it is in the target than in the documents; a document's weight is the mean over its
features, looked up in one array of gains.  Drawing without replacement in proportion to exp(weight)
is taking the largest weights after adding Gumbel noise, which comes from a hash of the id, so that a
repeated run draws the same documents.

The cutoff of the draw is located without sorting the table.  A quantile sketch of the scores brackets
it; exact counts outside the bracket say whether it really does, and widen it until it does; only the
rows inside are sorted.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField

from wattlake.llm.frames import with_computed
from wattlake.llm.words import lower_ascii, runs, text_bytes
from wattlake.session import scratch_path

#: Spans longer than this are hashed one by one.
_LONG = 64


def crc32_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The CRC-32 of the bytes of each span, a byte of all spans at a time."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    lengths = ends - starts
    order = np.argsort(-lengths, kind="stable")
    at, left = starts[order], lengths[order]
    many = int(np.searchsorted(-left, -_LONG, "left"))
    crc = np.full(len(order), 0xFFFFFFFF, np.uint32)
    for i in range(int(left[many]) if many < len(left) else 0):
        n = int(np.searchsorted(-left, -i, "left"))
        some = crc[many:n]
        crc[many:n] = table[(some ^ data[at[many:n] + i]) & 0xFF] ^ (some >> 8)
    crc ^= np.uint32(0xFFFFFFFF)
    for i in range(many):
        crc[i] = zlib.crc32(data[at[i] : at[i] + left[i]].tobytes())
    result = np.empty_like(crc)
    result[order] = crc
    return result


def feature_buckets(column: pa.Array, buckets: int, longest: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all features, where each text's begin, and each text's number of words.

    Words are runs of digits, letters a-z (A-Z are lower-cased) and characters beyond ASCII;
    features are all runs of 1 to ``longest`` words, joined by one space.
    """
    data, offsets = text_bytes(column)
    data = lower_ascii(data)
    inside = (data >= 0x80) | ((data >= 48) & (data <= 57)) | ((data >= 97) & (data <= 122))
    starts, ends = runs(inside, offsets)
    bounds = np.searchsorted(starts, offsets)
    if longest > 1:
        # the words again, one space after each, so that a run of words is a span of bytes
        lengths = ends - starts + 1
        fresh = np.cumsum(lengths) - lengths
        source = np.arange(int(lengths.sum())) - np.repeat(fresh - starts, lengths)
        data = np.append(data, np.uint8(32))[np.minimum(source, len(data))]
        data[fresh + lengths - 1] = 32
        starts, ends = fresh, fresh + lengths - 1
    last = np.repeat(bounds[1:], np.diff(bounds))
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    found, owner = [], []
    for size in range(1, longest + 1):
        first = np.flatnonzero(np.arange(len(starts)) + size <= last)
        found.append(crc32_spans(data, starts[first], ends[first + size - 1]) % np.uint32(buckets))
        owner.append(text[first])
    owners = np.concatenate(owner)
    order = np.argsort(owners, kind="stable")
    places = np.searchsorted(owners[order], np.arange(len(bounds)))
    return np.concatenate(found)[order], places, np.diff(bounds)


def bucket_counts(features: DataFrame, column: str, dtype: np.dtype, buckets: int) -> np.ndarray:
    """How many features of a table are in each bucket; tasks count first, Spark adds up."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for packed in batch.column(0):
                total += np.bincount(np.frombuffer(packed.as_buffer(), dtype), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": used, "n": total[used]})

    counted = features.select(column).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    result = np.zeros(buckets, np.int64)
    # as many rows as there are buckets at most
    for row in counted.collect():
        result[row["bucket"]] = row["n"]
    return result


def bucket_gains(ours: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln) of a bucket's frequency in the target over that in the documents, one added."""
    buckets = len(ours)
    all_ours, all_target = int(ours.sum()), int(target.sum())
    return np.array([
        math.floor(1000 * math.log(
            (float(t) + 1) * (float(all_ours) + buckets) / ((float(s) + 1) * (float(all_target) + buckets))
        ))
        for s, t in zip(ours.tolist(), target.tolist(), strict=True)
    ], np.int64)


def _featured(df: DataFrame, text_col: str, keep: list[str], buckets: int, longest: int) -> DataFrame:
    """``keep`` columns, the features as packed bucket numbers, and the numbers of them and of words."""
    dtype = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")
    fields = [
        StructField("features", BinaryType()), StructField("n_features", LongType()), StructField("n_words", LongType()),
    ]

    def compute(part: pa.RecordBatch) -> dict:
        found, places, words = feature_buckets(part.column("text"), buckets, longest)
        packed = pa.Array.from_buffers(
            pa.binary(), part.num_rows,
            [None, pa.py_buffer((places * dtype.itemsize).astype(np.int32)), pa.py_buffer(found.astype(dtype))],
        )
        return {"features": packed, "n_features": np.diff(places), "n_words": words}

    return with_computed(
        df.select(*keep, F.col(text_col).alias("text")), "text", fields, compute, keep=keep
    )


def _weighted(features: DataFrame, gains: np.ndarray, dtype: np.dtype) -> DataFrame:
    """The floored mean gain of each row's features; 0 without any."""

    def compute(part: pa.RecordBatch) -> dict:
        packed = part.column("features")
        places = np.frombuffer(packed.buffers()[1], np.int32)[packed.offset : packed.offset + len(packed) + 1]
        content = packed.buffers()[2]
        found = np.frombuffer(content, np.uint8)[places[0] : places[-1]].view(dtype) if content else np.zeros(0, dtype)
        total = np.concatenate([[0], np.cumsum(gains[found])])
        places = (places - places[0]) // dtype.itemsize
        sums, sizes = total[places[1:]] - total[places[:-1]], np.diff(places)
        return {"weight": np.where(sizes > 0, sums // np.maximum(sizes, 1), 0)}

    return with_computed(
        features, "features", [StructField("weight", LongType())], compute,
        keep=[c for c in features.columns if c != "features"],
    )


def gumbel_noise(id_col: Column, seed: int) -> Column:
    """floor(1000 * Gumbel noise) of a row, from the hash of the seed and its id (null: no text)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def _place(id_col: str) -> list[Column]:
    """The order of the draw as columns that all rise: best score, smaller id, null ids last."""
    return [
        (-F.col("score")).alias("by_score"), F.col(id_col).isNull().alias("by_null"),
        F.col(id_col).alias("by_id"), F.col("n_features").alias("by_size"), F.col("weight").alias("by_weight"),
    ]


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """The rows numbered from 1 in an order, without ever bringing them together.

    Sorted by range, a row's number is its place in its partition and the sizes of those before it;
    the sorted rows are written to the shared folder, so that all this is of one and the same order.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "numbered")
    keys = [F.col(f"__key{i}") for i in range(len(order))]
    keyed = df.select("*", *(c.alias(f"__key{i}") for i, c in enumerate(order)))
    (
        keyed.repartitionByRange(*keys).sortWithinPartitions(*keys)
        .withColumn("__at", F.monotonically_increasing_id())
        .drop(*(f"__key{i}" for i in range(len(order)))).write.parquet(path)
    )
    stored = spark.read.parquet(path)
    # Spark's documented layout of these numbers: the partition above 33 bits of the place in it
    part, place = F.call_function("shiftright", F.col("__at"), F.lit(33)), F.col("__at").bitwiseAND((1 << 33) - 1)
    sizes = sorted(stored.groupBy(part.alias("part")).count().collect())
    before, starts = 0, []
    for row in sizes:
        starts.append((row["part"], before))
        before += row["count"]
    # one row per partition of the sort
    offsets = spark.createDataFrame(starts, "__part long, __before long")
    return (
        stored.withColumn("__part", part).join(F.broadcast(offsets), "__part")
        .withColumn(name, F.col("__before") + place + 1).drop("__part", "__before", "__at")
    )


def bracket(scored: DataFrame, rank: int, rows: int, score_col: str = "score", accuracy: int = 10_000) -> tuple:
    """(low, high, above): scores that the row of a rank lies between, and the exact number of rows above.

    None stands for no limit.  A quantile sketch proposes the two; exact counts of the rows outside
    decide, and the side that is too narrow is widened until they hold.
    """
    low_room = high_room = 2.0 / accuracy
    share = 1 - rank / rows
    low = high = None
    while True:
        ends = [max(0.0, share - low_room), min(1.0, share + high_room)]
        low, high = scored.agg(F.percentile_approx(score_col, ends, accuracy).alias("ends")).first()["ends"]
        low, high = (None if ends[0] == 0.0 else low), (None if ends[1] == 1.0 else high)
        over = F.lit(False) if high is None else F.col(score_col) > high
        under = F.lit(False) if low is None else F.col(score_col) < low
        outside = scored.agg(F.count_if(over).alias("above"), F.count_if(under).alias("below")).first()
        if outside["above"] >= rank:
            high_room *= 8
        elif rows - outside["below"] < rank:
            low_room *= 8
        else:
            return low, high, outside["above"]


def draw(scored: DataFrame, eligible: Column, percent: int, id_col: str) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, 3... for the best floor(percent * N / 100) of the N eligible rows."""
    able = scored.filter(eligible)
    rows = able.count()
    size = rows * percent // 100
    none = F.lit(None).cast("long").alias("rank")
    if not size:
        return scored.select("*", none)
    low, high, above = bracket(able, size, rows)
    within = F.lit(True)
    if low is not None:
        within &= F.col("score") >= low
    if high is not None:
        within &= F.col("score") <= high
    keys = _place(id_col)
    last = numbered(able.filter(within).select("score", "n_features", "weight", id_col), keys, "at")
    # one row: what comes up to its place is drawn, which equal rows can make a few too many
    cutoff = last.filter(F.col("at") == size - above).select(*keys)
    place = F.struct(*(F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(cutoff.first(), cutoff.schema, strict=True)))
    drawn = F.coalesce(eligible & (F.struct(*keys) <= place), F.lit(False))
    ranked = numbered(scored.filter(drawn), keys, "rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= size, F.col("rank")))
    return ranked.unionByName(scored.filter(~drawn).select("*", none))


def importance_resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text: str = "text",
    buckets: int = 10_000,
    longest: int = 1,
    least_words: int = 20,
    percent: int = 10,
    seed: int = 2024,
) -> DataFrame:
    """(id, n_features, weight, score, rank, n_words) of every document; ``rank`` is null unless drawn.

    Of the documents with ``least_words`` words, ``percent`` of a hundred are drawn, rounded down:
    those with the highest scores (weight and noise), ties to smaller ids, then fewer features.
    A null or empty text has no features and weight 0; a null id is noised as an empty one and
    comes last among ties; rows that share an id share their noise and are drawn each for itself.
    Of an empty table nothing is drawn, and an empty target gives gains all the same.  Other
    columns are not returned; :func:`drawn_documents` brings them back.
    """
    spark = docs.sparkSession
    dtype = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")
    root = scratch_path(spark, "resampling")

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{root}/{name}")
        return spark.read.schema(df.schema).parquet(f"{root}/{name}")

    features = written(_featured(docs, text_col, [id_col], buckets, longest), "features")
    ours = bucket_counts(features, "features", dtype, buckets)
    wanted = bucket_counts(_featured(target, target_text, [], buckets, longest), "features", dtype, buckets)
    weighted = _weighted(features, bucket_gains(ours, wanted), dtype)
    score = F.col("weight") + gumbel_noise(F.col(id_col), seed)
    scored = written(weighted.withColumn("score", score), "scored")
    return draw(scored, F.col("n_words") >= least_words, percent, id_col).select(
        id_col, "n_features", "weight", "score", "rank", "n_words"
    )


def drawn_documents(docs: DataFrame, resampled: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose id was drawn, with all their columns as they are."""
    return docs.join(resampled.filter(F.col("rank").isNotNull()).select(id_col).distinct(), id_col, "left_semi")

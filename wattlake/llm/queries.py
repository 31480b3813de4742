"""Named queries of the subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattlake.llm import (
    forest,
    html_text,
    language,
    licenses,
    ngram_join,
    packing,
    passages,
    pieces,
    quality_model,
    quality_rules,
    resampling,
    topk,
    vectors,
    whitening,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    model = pieces.read_model(public_tokenizers.path("piece_bpe_32k.model"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.encode_and_decode(docs, model, digests=True)


def ngram_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit_language_model(docs)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    return language.identify_language(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score"
    )


def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return passages.remove_repeated_passages(docs, rejoin_all=True).select(
        "doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256")
    )


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    model = quality_model.fit_quality_model(docs, table(spark, sf_dir, "labels"))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    return quality_model.score_quality(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", "predicted"
    )


def risk_controlled_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality_rules.apply_quality_rules(docs, table(spark, sf_dir, "labels"), keep=["doc_id"]).select(
        "doc_id", *quality_rules.BASE, "base_failed", "kept"
    )


def scaled(x):
    """floor(64 * x) as a double; what is too large to have a fraction stays as it is."""
    y = 64 * x.cast("double")
    return F.when(F.abs(y) < 2.0**53, F.floor(y).cast("double")).otherwise(y)


def exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select(
        "vec_id", F.transform("embedding", scaled).alias("vector")
    )
    return topk.top_k(vectors, F.col("vec_id") % 20 == 0)


def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract_text(pages, keep=["page_id", "url"]).select("page_id", "url", "text", "n_chars")


def nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.importance_resample(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    ).select("doc_id", "n_features", "weight", "score", "rank")


def fixed_point(x):
    """floor(64 * x) + 1000000 as a long; what no long can hold exactly is an error."""
    y = 64 * x.cast("double")
    whole = F.floor(y) + F.lit(1_000_000).cast("long")
    return F.when(F.abs(y) < 2.0**52, whole).otherwise(F.raise_error(F.lit("component too large for fixed point")))


def embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").filter(vectors.usable(F.col("embedding")))
    fixed = rows.select("vec_id", F.transform("embedding", fixed_point).alias("vector"))
    return whitening.whitened_components(fixed, components=32).withColumn("component", F.col("component").cast("int"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_best_fit_packing": pack,
        "op2_sentencepiece": sentencepiece,
        "op3_ngram_jaccard": ngram_components,
        "op4_language_id": language_id,
        "op5_substring_dedup": substring_dedup,
        "op6_license_scan": license_scan,
        "op7_quality_classifier": quality_classifier,
        "op8_quality_rules": risk_controlled_rules,
        "op9_exact_top_k": exact_top_k,
        "op10_html_extraction": html_extraction,
        "op11_nearest_neighbours": nearest_neighbours,
        "op12_importance_resampling": importance_resampling,
        "op13_embedding_whitening": embedding_whitening,
    }


#: Words of every document, with their number from 1.
_WORDS = r"""
words AS (
    SELECT doc_id, regexp_extract_all(coalesce({text}, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
)"""

SUBSTRING_DEDUP = "WITH" + _WORDS.format(text="text") + """,
windows AS (
    SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS words
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words)
),
repeated AS (
    SELECT w.doc_id, w.i FROM windows w
    JOIN (SELECT words, min(doc_id) AS least FROM windows GROUP BY words) m USING (words)
    WHERE w.doc_id > m.least
),
gone AS (
    SELECT DISTINCT doc_id, i + unnest(range(50)) AS i FROM repeated
),
kept AS (
    SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text
    FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM words)
    ANTI JOIN gone USING (doc_id, i)
    GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""

NGRAM_JACCARD = "WITH RECURSIVE" + _WORDS.format(
    text="translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
) + """,
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
    FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
    GROUP BY ALL
),
links AS (
    SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
    WHERE 100 * c >= 75 * (p.n + q.n - c)
),
reach AS (
    SELECT doc_id AS x, doc_id AS y FROM documents
    UNION
    SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, coalesce(n_links, 0) AS n_links
FROM documents LEFT JOIN sizes USING (doc_id)
LEFT JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x) USING (doc_id)
LEFT JOIN (SELECT x AS doc_id, count(*) AS n_links FROM links GROUP BY x) USING (doc_id)
"""

EXACT_TOP_K = """
WITH vectors AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id
    WHERE q.vec_id % 20 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank,
       vec_id, score
FROM scored
QUALIFY rank <= 20
"""


#: CRC-32 of a word, whose bytes come from its hexadecimal digits: the remainder after each byte is
#: looked up in the table of the 256 remainders.
IMPORTANCE_RESAMPLING = r"""
WITH crc AS (
    SELECT list(c ORDER BY b) AS t FROM (
        SELECT b, list_reduce(range(8), lambda c, i: CASE WHEN c % 2 = 1
                   THEN xor(c // 2, 3988292384) ELSE c // 2 END, b) AS c
        FROM (SELECT unnest(range(256)) AS b))
),
texts AS (
    SELECT 'd' AS kind, doc_id, text FROM documents
    UNION ALL SELECT 'b', NULL, text FROM benchmark
),
words AS (
    SELECT kind, doc_id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
    FROM texts
),
counted AS (SELECT kind, doc_id, w, count(*) AS n FROM words GROUP BY ALL),
hashed AS (
    SELECT w, xor(4294967295, list_reduce(
        list_transform(range(len(h) // 2),
            lambda i: (instr(digits, h[2 * i + 1]) - 1) * 16 + instr(digits, h[2 * i + 2]) - 1),
        lambda c, x: xor(c // 256, t[xor(c % 256, x) + 1]), 4294967295)) % 10000 AS bucket
    FROM (SELECT w, hex(encode(w)) AS h, '0123456789ABCDEF' AS digits
          FROM (SELECT DISTINCT w FROM counted)), crc
),
buckets AS (
    SELECT bucket, coalesce(sum(n) FILTER (kind = 'd'), 0)::DOUBLE AS s,
           coalesce(sum(n) FILTER (kind = 'b'), 0)::DOUBLE AS t
    FROM counted JOIN hashed USING (w) GROUP BY bucket
),
gains AS (
    SELECT bucket, floor(1000 * ln((t + 1) * ((SELECT sum(s) FROM buckets) + 10000)
                         / ((s + 1) * ((SELECT sum(t) FROM buckets) + 10000))))::BIGINT AS gain
    FROM buckets
),
weights AS (
    SELECT doc_id, sum(n)::BIGINT AS n_features, floor(sum(n * gain) / sum(n))::BIGINT AS weight
    FROM counted JOIN hashed USING (w) JOIN gains USING (bucket) WHERE kind = 'd' GROUP BY doc_id
),
noise AS (
    SELECT doc_id, list_reduce(list_transform(range(8),
        lambda i: instr('0123456789abcdef', sha256('2024:' || doc_id)[i + 1]) - 1),
        lambda a, x: a * 16 + x, 0::BIGINT) AS h
    FROM documents
),
scored AS (
    SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
           coalesce(weight, 0) + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
    FROM noise LEFT JOIN weights USING (doc_id)
),
able AS (
    SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n
    FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank
FROM scored LEFT JOIN able USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    """The others have no SQL; their tests compare them with brute force."""
    return {
        "op3_ngram_jaccard": NGRAM_JACCARD,
        "op5_substring_dedup": SUBSTRING_DEDUP,
        "op9_exact_top_k": EXACT_TOP_K,
        "op12_importance_resampling": IMPORTANCE_RESAMPLING,
    }

"""Language identification with string kernels.

A text is the set of character n-grams it contains, of several lengths at once (the blended
spectrum, presence only), hashed to a fixed number of dimensions.  The kernel of two texts is the
number of common n-grams over the geometric mean of their numbers.  A few labelled texts are
landmarks; the Nystroem method turns kernel values with them into features, on which one-versus-
rest kernel ridge regression is fitted.  Scoring a batch is a product of its presence matrix with
the landmarks', and one more with the fitted coefficients.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, StringType, StructField

from wattlake.llm.frames import with_computed
from wattlake.llm.words import scrambled, text_bytes

BITS = 14
DIMS = 1 << BITS
LENGTHS = (2, 3, 4)
ROWS_AT_ONCE = 512
CHARACTERS_AT_ONCE = 1 << 20
UNKNOWN = "und"
_BASE = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=1)
def _small_letters() -> np.ndarray:
    """For the code points of two bytes: letters in lower case, other ASCII as one kind of
    separator, the rest as it is."""
    table = np.arange(1 << 16, dtype=np.uint32)
    for code in range(1 << 16):
        small = chr(code).lower()
        if code < 128 and not small.isalpha():
            table[code] = 32
        elif len(small) == 1:
            table[code] = ord(small)
    return table


def folded_characters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The folded code points of texts in UTF-8, and where each text begins among them."""
    leads = (data & 0xC0) != 0x80
    starts = np.flatnonzero(leads)
    first = data[starts]
    code = first.astype(np.uint32)
    longer = np.flatnonzero(first >= 0xC0)
    if len(longer):
        padded = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.uint32)
        at, lead = starts[longer], code[longer]
        one, two, three = (padded[at + i] & 63 for i in (1, 2, 3))
        code[longer] = np.select(
            [lead < 0xE0, lead < 0xF0],
            [(lead & 31) << 6 | one, (lead & 15) << 12 | one << 6 | two],
            (lead & 7) << 18 | one << 12 | two << 6 | three,
        )
    common = code < 1 << 16
    code[common] = _small_letters()[code[common]]
    return code, np.concatenate([[0], np.cumsum(leads)])[offsets]


def presence_blocks(column: pa.Array):
    """Yields boolean matrices (texts by n-gram dimensions) for up to ``ROWS_AT_ONCE`` texts."""
    data, offsets = text_bytes(column)
    for a in range(0, len(offsets) - 1, ROWS_AT_ONCE):
        b = min(a + ROWS_AT_ONCE, len(offsets) - 1)
        part, places = folded_characters(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        row = np.repeat(np.arange(b - a, dtype=np.int64), np.diff(places))
        x = np.zeros((b - a, DIMS), bool)
        flat = x.reshape(-1)
        # a very long text goes in pieces that overlap by an n-gram
        for begin in range(0, len(part), CHARACTERS_AT_ONCE):
            piece = slice(begin, begin + CHARACTERS_AT_ONCE + max(LENGTHS) - 1)
            of, values = row[piece], scrambled(part[piece].astype(np.uint64) + np.uint64(1))
            code = values
            for n in range(2, min(max(LENGTHS), len(values)) + 1):
                # all characters, and their number, tell in the upper bits
                code = code[:-1] * _BASE + values[n - 1 :]
                if n in LENGTHS:
                    at = of[: len(code)] * DIMS + (code >> np.uint64(64 - BITS)).astype(np.int64)
                    flat[at[of[: len(code)] == of[n - 1 :]]] = True
        yield x


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    landmarks: np.ndarray
    coefficients: np.ndarray

    def scores(self, present: np.ndarray) -> np.ndarray:
        return kernel(present, self.landmarks) @ self.coefficients


def kernel(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    right = y.astype(np.float32).T
    at_once = range(0, max(len(x), 1), ROWS_AT_ONCE)
    common = np.concatenate([x[a : a + ROWS_AT_ONCE].astype(np.float32) @ right for a in at_once])
    size = np.sqrt(np.maximum(x.sum(1), 1)[:, None] * np.maximum(y.sum(1), 1)[None, :])
    return common / size.astype(np.float32)


def fit_ridge(
    present: np.ndarray, langs: list[str], landmarks: int = 128, ridge: float = 1e-3, seed: int = 5
) -> LanguageModel:
    """Nystroem features from landmarks of all languages in turn, then ridge regression."""
    names = tuple(sorted(set(langs)))
    random = np.random.default_rng(seed)
    pools = [list(random.permutation([i for i, l in enumerate(langs) if l == n])) for n in names]
    chosen = []
    while len(chosen) < landmarks and any(pools):
        chosen += [pool.pop() for pool in pools if pool]
    marks = present[chosen]
    inner = kernel(marks, marks).astype(np.float64)
    values, vectors = np.linalg.eigh(inner)
    root = vectors * np.where(values > 1e-6, 1 / np.sqrt(np.maximum(values, 1e-6)), 0)
    features = kernel(present, marks) @ root
    targets = np.array([[float(l == n) for n in names] for l in langs])
    # every language weighs the same, however often it occurs in the sample
    weight = (1 / targets.sum(0))[targets.argmax(1)][:, None]
    gram = features.T @ (features * weight) + ridge * np.eye(features.shape[1])
    solved = np.linalg.solve(gram, features.T @ (targets * weight))
    return LanguageModel(names, marks, (root @ solved).astype(np.float32))


def fit_language_model(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample_per_language: int = 300,
    sample: int = 6000,
) -> LanguageModel | None:
    """The model, fitted on at most ``sample_per_language`` texts of each language and ``sample``
    in all, the first by a hash of the id; None without labelled texts.

    Documents whose ``crc32(id as text) mod 4`` is 2 are held out.  Executors turn texts into sets
    of n-grams; the driver gets ``DIMS`` bits per sampled text.
    """
    told = (
        docs.select(
            F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"),
            F.col(text_col).alias("text"),
        )
        .filter(F.col("id").isNotNull() & F.col("lang").isNotNull())
        .filter(F.crc32(F.col("id").cast("string")) % 4 != 2)
        .filter(has_letter("text"))
    )
    # choose ids without their texts, then fetch the texts of those: first within many parts of a
    # language, then within fewer, so that a task gets a few thousand ids at most besides its own
    picked = told.select("id", "lang", F.xxhash64("id").alias("hash"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(64)).alias("part"))
    for parts in (64, 8, 1):
        picked = picked.withColumn("part", F.pmod("part", F.lit(parts)))
        firsts = Window.partitionBy("lang", "part").orderBy("hash", "id")
        picked = picked.withColumn("n", F.row_number().over(firsts)).filter(F.col("n") <= sample_per_language)
    picked = picked.orderBy("n", "lang").limit(sample).select("id")
    few = told.join(F.broadcast(picked.distinct()), "id").select("lang", "text")

    def compute(part: pa.RecordBatch) -> dict:
        return {"bits": [np.packbits(r).tobytes() for x in presence_blocks(part.column("text")) for r in x]}

    found = with_computed(few, "text", [StructField("bits", BinaryType())], compute, ["lang"]).collect()
    found = sorted((r["lang"], bytes(r["bits"])) for r in found)
    if not found:
        return None
    bits = np.array([np.unpackbits(np.frombuffer(b, np.uint8)) for _, b in found]).astype(bool)
    return fit_ridge(bits, [lang for lang, _ in found])


def has_letter(text_col: str):
    return F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))


def identify_language(
    docs: DataFrame, model: LanguageModel | None, text_col: str = "text"
) -> DataFrame:
    """All columns of ``docs``, ``lang_pred`` and ``score``.

    Only the text, and all of it, is looked at.  ``lang_pred`` is a language of the model, or
    ``und`` with score 0 for a text that is null or has no letter, and for all texts if there is
    no model.  ``score`` is the regression value of the language, cut to 0 to 1; of equal values
    the first language by name wins.  Repeated rows get the same result; columns of ``docs``
    named like results are replaced.
    """

    def compute(part: pa.RecordBatch) -> dict:
        letters = np.asarray(part.column("__letters").to_numpy(zero_copy_only=False), bool)
        best, score = np.zeros(len(letters), int), np.zeros(len(letters))
        at = 0
        for x in presence_blocks(part.column(text_col)) if model else ():
            values = model.scores(x)
            best[at : at + len(x)] = values.argmax(1)
            score[at : at + len(x)] = np.clip(values.max(1), 0, 1)
            at += len(x)
        known = letters & (model is not None)
        names = np.array([*(model.languages if model else ()), UNKNOWN], object)
        return {
            "lang_pred": names[np.where(known, best, len(names) - 1)].tolist(),
            "score": np.where(known, score, 0.0),
        }

    fields = [StructField("lang_pred", StringType(), False), StructField("score", DoubleType(), False)]
    lettered = docs.withColumn("__letters", has_letter(text_col))
    return with_computed(lettered, text_col, fields, compute, keep=docs.columns)

"""Quality classifier: a factorisation machine over hashed words and the shape of the text.

A document is a vector of hashed words (presence, unit length), indicators of its structure
(symbols, capitals, repeated lines and phrases, word length, ...), its size, and indicators of
its metadata (numeric columns, ``n_chars`` unless told otherwise).  The machine adds to a linear score the interactions of all pairs of features, with weights of low rank::

    sum_{i<j} <v_i, v_j> x_i x_j = 1/2 sum_f [ (sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2 ]

so a batch of documents, kept as sparse rows, is scored in time linear in the features they have.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, IntegerType, NumericType, StructField

from wattlake.llm.frames import with_computed
from wattlake.llm.text_stats import text_stats

WORD_DIMS = 1 << 15

#: Borders of the indicators' cells; fixed, so that a document's features depend on it alone.
EDGES = {
    "symbols": (0.01, 0.05, 0.1, 0.2, 0.4, 0.7),
    "marks": (0.02, 0.1, 0.2, 0.3, 0.5, 0.8, 1.2),
    "capitals": (0.01, 0.05, 0.1, 0.2, 0.5, 0.8),
    "dup_lines": (0.001, 0.05, 0.1, 0.2, 0.4, 0.7),
    "repeats": (0.001, 0.02, 0.05, 0.1, 0.2, 0.4, 0.7),
    "word_chars": (2, 3, 4, 5, 6, 7, 9, 12, 20),
    "digits": (0.001, 0.01, 0.05, 0.2),
    "words": (1, 5, 10, 20, 50, 100, 300, 1000, 3000, 10000),
    "distinct": (0.05, 0.1, 0.2, 0.3, 0.5, 0.7, 0.9),
}
STAT_DIMS = sum(len(edges) + 1 for edges in EDGES.values())
DIMS = WORD_DIMS + STAT_DIMS
#: Borders of the cells of a metadata column; unknown (null or NaN) is a cell of its own, the last.
METADATA_EDGES = (0, 1, 10, 30, 100, 300, 1000, 3000, 10_000, 30_000, 100_000, 1_000_000)
METADATA_DIMS = len(METADATA_EDGES) + 2


def metadata_columns(docs: DataFrame, names: Sequence[str] | None) -> tuple[str, ...]:
    """``names``, which must be numeric columns; if None, ``n_chars`` where it is one."""
    numeric = {f.name for f in docs.schema.fields if isinstance(f.dataType, NumericType)}
    if names is None:
        return tuple(c for c in ("n_chars",) if c in numeric)
    if missing := [c for c in names if c not in numeric]:
        raise ValueError(f"not numeric columns: {missing}")
    return tuple(names)


def _metadata_cells(column: pa.Array) -> np.ndarray:
    values = column.cast(pa.float64(), safe=False).to_numpy(zero_copy_only=False)
    cells = np.searchsorted(METADATA_EDGES, values, "right")
    return np.where(np.isnan(values), METADATA_DIMS - 1, cells)


class SparseRows(NamedTuple):
    """Features (numbers and values) of all rows; those of row i begin at ``bounds[i]``.  No row
    is without features."""

    bounds: np.ndarray
    features: np.ndarray
    values: np.ndarray


def feature_rows(column: pa.Array, metadata: Sequence[pa.Array] = ()) -> SparseRows:
    """The features of texts: the cells of their words, then one cell of every indicator."""
    stats = text_stats(column, hashed=True)
    words, hashes = stats["words"], stats["hashes"]
    texts = len(words.bounds) - 1
    row = np.repeat(np.arange(texts), np.diff(words.bounds))
    keys = row * WORD_DIMS + (hashes % np.uint64(WORD_DIMS)).astype(np.int64)
    keys.sort()
    of, cell = np.divmod(keys[np.diff(keys, prepend=-1) != 0], WORD_DIMS)
    present = np.bincount(of, minlength=texts)
    n = np.maximum(stats["n_words"], 1)
    letters = np.maximum(stats["n_capitals"] + stats["n_small"], 1)
    shape = {
        "symbols": stats["n_symbols"] / n,
        "marks": stats["n_marks"] / n,
        "capitals": stats["n_capitals"] / letters,
        "dup_lines": stats["n_dup_lines"] / stats["n_lines"],
        "repeats": stats["n_repeat_words"] / n,
        "word_chars": stats["word_chars"] / n,
        "digits": stats["n_digits"] / np.maximum(stats["word_chars"], 1),
        "words": stats["n_words"],
        "distinct": present / np.minimum(n, WORD_DIMS),
    }
    indicators = []
    at = WORD_DIMS
    for name, edges in EDGES.items():
        indicators.append(at + np.searchsorted(edges, shape[name], "right"))
        at += len(edges) + 1
    for one in metadata:
        indicators.append(at + _metadata_cells(one))
        at += METADATA_DIMS
    more = len(indicators)
    bounds = np.concatenate([[0], np.cumsum(present + more)])
    features, values = np.empty(bounds[-1], np.int32), np.ones(bounds[-1])
    places = np.arange(len(of)) + of * more
    features[places] = cell
    values[places] = (1 / np.sqrt(np.maximum(present, 1)))[of]
    for i, one in enumerate(indicators):
        features[bounds[1:] - more + i] = one
    return SparseRows(bounds, features, values)


@dataclass(frozen=True)
class FactorisationMachine:
    bias: float
    weights: np.ndarray
    factors: np.ndarray
    metadata: tuple[str, ...] = ()

    def scores(self, rows: SparseRows) -> np.ndarray:
        """The probability of label 1 for each row."""
        begins = rows.bounds[:-1]
        if not len(begins):
            return np.zeros(0)
        scaled = self.factors[rows.features] * rows.values[:, None]
        together = np.add.reduceat(scaled, begins)
        alone = np.add.reduceat((scaled * scaled).sum(1), begins)
        linear = np.add.reduceat(self.weights[rows.features] * rows.values, begins)
        raw = self.bias + linear + 0.5 * ((together * together).sum(1) - alone)
        return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


def gradients(
    bias: float, w: np.ndarray, v: np.ndarray, rows: SparseRows, labels: np.ndarray, decay: float
) -> list[np.ndarray]:
    """Those of the mean logistic loss and ``decay / 2`` times the squares of the weights, by bias,
    weights and factors."""
    begins, at = rows.bounds[:-1], rows.features
    scaled = v[at] * rows.values[:, None]
    together = np.add.reduceat(scaled, begins)
    alone = np.add.reduceat((scaled * scaled).sum(1), begins)
    raw = bias + np.add.reduceat(w[at] * rows.values, begins) + 0.5 * ((together**2).sum(1) - alone)
    error = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels) / len(labels)
    row = np.repeat(np.arange(len(labels)), np.diff(rows.bounds))
    pulls = error[row] * rows.values
    sums = [np.bincount(at, pulls * one, len(w)) for one in (1.0, rows.values, *together.T[:, row])]
    return [
        np.array([error.sum()]),
        sums[0] + decay * w,
        np.stack(sums[2:], 1) - v * sums[1][:, None] + decay * v,
    ]


def fit_machine(
    rows: list[tuple[np.ndarray, np.ndarray]],
    labels: np.ndarray,
    rank: int = 8,
    epochs: int = 12,
    rate: float = 0.02,
    decay: float = 1e-4,
    seed: int = 7,
    dims: int = DIMS,
) -> FactorisationMachine:
    """Logistic loss by Adam over mini-batches of sparse rows (feature numbers and values).

    A step looks at the features of its batch alone.  Features that no row has weigh nothing.
    """
    random = np.random.default_rng(seed)
    share = np.clip(labels.mean(), 0.01, 0.99) if len(labels) else 0.5
    b = np.array([np.log(share / (1 - share))])
    w, v = np.zeros(dims), random.normal(0, 0.01, (dims, rank))
    params = [b, w, v]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    place_of = np.zeros(dims, np.int64)
    step = 0
    for _ in range(epochs if len(set(labels.tolist())) > 1 else 0):
        for at in np.array_split(random.permutation(len(labels)), max(1, len(labels) // 128)):
            features = np.concatenate([rows[r][0] for r in at])
            values = np.concatenate([rows[r][1] for r in at]).astype(float)
            bounds = np.cumsum([0, *(len(rows[r][0]) for r in at)])
            mine = np.flatnonzero(np.bincount(features, minlength=dims))
            place_of[mine] = np.arange(len(mine))
            step += 1
            changes = gradients(b[0], w[mine], v[mine], SparseRows(bounds, place_of[features], values), labels[at], decay)
            for p, g, (m, s), on in zip(params, changes, moments, (slice(None), mine, mine), strict=True):
                first, second = m[on], s[on]
                first = m[on] = first + 0.1 * (g - first)
                second = s[on] = second + 0.001 * (g * g - second)
                p[on] -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    unseen = np.ones(dims, bool)
    for features, _ in rows:
        unseen[features] = False
    v[unseen] = 0
    return FactorisationMachine(float(b[0]), w.astype(np.float32), v.astype(np.float32))


def learnable(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """(__id, label) of the labelled documents that are not held out; of two labels the lower."""
    return (
        labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
        .filter(F.crc32(F.col(id_col).cast("string")) % 3 != 1)
        .groupBy(F.col(id_col).alias("__id"))
        .agg(F.min(label_col).cast("int").alias("label"))
    )


def training_sample(
    docs: DataFrame, told: DataFrame, id_col: str, text_col: str, sample_per_label: int,
    metadata: Sequence[str] = (),
) -> DataFrame:
    """(text, label, one ``__meta`` column each of ``metadata``): up to ``sample_per_label`` documents of each label, first by a hash of the id.

    The ids are chosen first; of the texts, only the chosen ones are moved.
    """
    picked = None
    for label in (0, 1):
        one = told.filter(F.col("label") == label).orderBy(F.xxhash64("__id"), "__id").limit(sample_per_label)
        picked = one if picked is None else picked.unionByName(one)
    more = [F.col(c).alias(f"__meta{i}") for i, c in enumerate(metadata)]
    few = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text"), *more)
    return few.join(F.broadcast(picked), "__id").drop("__id")


def fit_quality_model(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", sample_per_label: int = 3000, metadata: Sequence[str] | None = None,
) -> FactorisationMachine:
    """The machine, fitted on at most ``2 * sample_per_label`` labelled documents.

    Documents whose ``crc32(id as text) mod 3`` is 1 are held out.  Executors turn the texts into
    features; the driver gets at most ``DIMS`` features, and one a metadata column, per document.  The sample has as many of
    either label; the bias is corrected to the shares of all labels that are not held out.
    ``metadata`` names numeric columns that are features too; None stands for ``n_chars``, if the
    table has it.
    """
    used = metadata_columns(docs, metadata)
    told = learnable(labels, id_col, label_col)
    shares = {r["label"]: r["count"] for r in told.groupBy("label").count().collect()}
    sample = training_sample(docs, told, id_col, text_col, sample_per_label, used)
    dims = DIMS + METADATA_DIMS * len(used)

    def compute(part: pa.RecordBatch) -> dict:
        more = [part.column(f"__meta{i}") for i in range(len(used))]
        found = feature_rows(part.column("text"), more)
        pairs = list(zip(found.bounds[:-1], found.bounds[1:], strict=True))
        return {"features": [found.features[a:b].astype(np.uint16).tobytes() for a, b in pairs],
                "values": [found.values[a:b].astype(np.float16).tobytes() for a, b in pairs]}

    fields = [StructField("features", BinaryType()), StructField("values", BinaryType())]
    found = with_computed(sample, "text", fields, compute, keep=["label"]).collect()
    # the order of collected rows may change from run to run
    found = sorted((r["label"], bytes(r["features"]), bytes(r["values"])) for r in found)
    rows = [(np.frombuffer(f, np.uint16), np.frombuffer(v, np.float16)) for _, f, v in found]
    labels_found = np.array([r[0] for r in found], float)
    model = replace(fit_machine(rows, labels_found, dims=dims), metadata=used)
    ones, zeros = labels_found.sum(), (1 - labels_found).sum()
    if not (ones and zeros):
        return model
    shift = np.log(shares[1] / shares[0]) - np.log(ones / zeros)
    return replace(model, bias=model.bias + float(shift))


def score_quality(
    docs: DataFrame, model: FactorisationMachine, text_col: str = "text"
) -> DataFrame:
    """All columns of ``docs``, ``score`` (0 to 1, higher: label 1 likelier) and ``predicted``.

    Only the text and the metadata columns the machine was fitted with are looked at; these must be
    there.  A null or empty text is scored by its (lack of) structure.
    Repeated rows get the same score; columns of ``docs`` named like results are replaced.  An
    empty table gives an empty table; a machine fitted without both labels scores by their share.
    """
    used = metadata_columns(docs, model.metadata)

    def compute(part: pa.RecordBatch) -> dict:
        more = [part.column(c) for c in used]
        scores = model.scores(feature_rows(part.column(text_col), more))
        return {"score": scores, "predicted": (scores >= 0.5).astype(np.int32)}

    fields = [StructField("score", DoubleType(), False), StructField("predicted", IntegerType(), False)]
    return with_computed(docs, text_col, fields, compute)

"""Quality rules whose cutoffs come with a guarantee: few good documents are rejected.

Fixed base rules reject what is hardly text.  The further rules have cutoffs per stratum.  A setting
gives every rule of a stratum its cutoff, and the settings form a sequence from lenient to strict: each
rejects a larger share, by each rule, of the stratum's documents outside the holdout, which is three
quarters of those labelled good.  So the sequence does not depend on the documents it is tested on:
going along it, a setting is accepted while the exact binomial (Clopper-Pearson) test shows that all its rules together reject less
than the allowed share of good documents, and the search stops at the first that fails.  Testing in a
fixed order needs no correction; the number of strata is corrected for by Bonferroni.  So with probability
``1 - delta`` no stratum loses more than its share of good documents.  About ``log(strata / delta) / risk``
documents in a stratum's holdout are enough for a cutoff: 220 with four strata and the defaults.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from wattlake.llm.frames import with_computed
from wattlake.llm.text_stats import text_stats
from wattlake.session import scratch_path

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_MORE = ("n_capitals", "n_small", "n_marks", "n_lines")
#: Counts that are not results get names no table is likely to have.
_OWN = "__"

#: Cells a rule's range is divided into; a cutoff is a cell, and rejects what lies in cells above it.
CELLS = 400

#: Shares of the documents outside the holdout that each rule rejects, setting by setting.
SETTINGS = (0.0, *(0.0005 * 1.25**n for n in range(30)))


def _share(part, whole):
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(0.0)


#: Up to so many cutoffs are sent to all tasks; beyond that Spark plans the join with them.
BROADCAST_CUTOFFS = 10_000

#: Rules: a statistic between 0 and its upper limit; high values are bad.
RULES = {
    "symbols_per_word": (lambda: _share("n_symbols", "n_words"), 4.0),
    "marks_per_word": (lambda: _share("__n_marks", "n_words"), 4.0),
    "capital_share": (
        lambda: F.when(
            F.col("__n_capitals") + F.col("__n_small") > 0,
            F.col("__n_capitals") / (F.col("__n_capitals") + F.col("__n_small")),
        ).otherwise(0.0),
        1.0,
    ),
    "duplicate_line_share": (lambda: _share("n_dup_lines", "__n_lines"), 1.0),
    "repeated_word_share": (lambda: _share("n_repeat_words", "n_words"), 1.0),
    "word_length": (lambda: _share("word_chars", "n_words"), 40.0),
}


def with_stats(docs: DataFrame, text_col: str, keep: Sequence[str] | None = None) -> DataFrame:
    names = {name: name for name in BASE} | {_OWN + name: name for name in _MORE}

    def compute(part: pa.RecordBatch) -> dict:
        stats = text_stats(part.column(text_col))
        return {column: stats[name] for column, name in names.items()}

    fields = [StructField(column, LongType(), False) for column in names]
    return with_computed(docs, text_col, fields, compute, keep)


def base_failed():
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def log_binomial_cdf(k: int, n: int, p: float) -> float:
    """log P(X <= k) for X ~ Binomial(n, p)."""
    if k >= n:
        return 0.0
    i = np.arange(k + 1)
    choose = np.array([math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) for j in i])
    terms = choose + i * math.log(p) + (n - i) * math.log1p(-p)
    top = terms.max()
    return float(top + np.log(np.exp(terms - top).sum()))


def accepted_setting(rejected: Sequence[int], n: int, risk: float, delta: float) -> int | None:
    """The strictest setting that passes the exact test before the first that fails, or None.

    ``rejected[s]`` of ``n`` good documents are rejected by setting s; settings become stricter.
    Testing H: "rejects a share of ``risk`` or more", the p-value is P(X <= rejected).
    """
    best = None
    for step, count in enumerate(rejected):
        if count > risk * n or log_binomial_cdf(int(count), n, risk) > math.log(delta):
            break
        best = step
    return best


def cell_of(name: str):
    """Which cell of its range a rule's statistic lies in; beyond it, in the last."""
    stat, top = RULES[name]
    return F.least(F.lit(CELLS), F.ceil(stat() / top * CELLS).cast("int"))


def settings_passed(name: str):
    """How many settings of a rule's ladder a row passes; cutoffs fall, so those are the first."""
    cell = cell_of(name)
    return F.size(F.filter(f"__{name}", lambda cutoff: cell <= cutoff))


def settings_of(cells: np.ndarray) -> list[int]:
    """The cutoff cell per setting, from how many documents lie in each: the least cell above which
    no more than the setting's share of them lies.  Without documents no cell is ruled out."""
    total = int(cells.sum())
    if not total:
        return [CELLS] * len(SETTINGS)
    above = total - np.cumsum(cells)
    return [int(np.argmax(above <= share * total)) for share in SETTINGS]


def fit_cutoffs(
    counted: DataFrame, stratum_col: str, risk: float, delta: float
) -> tuple[DataFrame, dict]:
    """Cutoffs from rows with the stats columns, a stratum and ``held`` (in the holdout).

    Two passes over counts: rows outside the holdout are counted per stratum, rule and cell, which
    gives the sequence of settings; each row in it is then counted under the first setting that
    rejects it.  The driver sees at most strata x rules x cells, then strata x settings rows.
    """
    spark = counted.sparkSession
    cells = [F.struct(F.lit(name).alias("rule"), cell_of(name).alias("cell")) for name in RULES]
    found = (
        counted.filter("NOT held")
        .select(F.col(stratum_col).alias("stratum"), F.explode(F.array(*cells)).alias("c"))
        .groupBy("stratum", "c.rule", "c.cell")
        .count()
        .collect()
    )
    shape: dict = {}
    for row in found:
        shape.setdefault((row["stratum"], row["rule"]), np.zeros(CELLS + 1, np.int64))[row["cell"]] += row["count"]
    strata = [row["stratum"] for row in counted.filter("held").select(F.col(stratum_col).alias("stratum")).distinct().collect()]
    none = np.zeros(CELLS + 1, np.int64)
    steps = {(s, r): settings_of(shape.get((s, r), none)) for s in strata for r in RULES}
    ladder = ", ".join(f"__{r} array<int>" for r in RULES)
    ladders = spark.createDataFrame([(s, *(steps[s, r] for r in RULES)) for s in strata], f"__stratum string, {ladder}")
    firsts = [settings_passed(r) for r in RULES]
    rejected = (
        counted.filter("held")
        .join(bounded(ladders, len(strata)), F.col(stratum_col).cast("string").eqNullSafe(F.col("__stratum")))
        .groupBy(F.col(stratum_col).alias("stratum"), F.least(*firsts).alias("first"))
        .count()
        .collect()
    )
    first: dict = {}
    for row in rejected:
        first.setdefault(row["stratum"], np.zeros(len(SETTINGS) + 1, np.int64))[row["first"]] += row["count"]
    cutoffs = {}
    for stratum, counts in first.items():
        step = accepted_setting(np.cumsum(counts)[:-1], int(counts.sum()), risk, delta / len(first))
        if step is not None:
            for rule in RULES:
                cutoffs[stratum, rule] = steps[stratum, rule][step]
    rows = [(s, *(cutoffs.get((s, r)) for r in RULES)) for s in sorted(first, key=str)]
    schema = "__stratum string, " + ", ".join(f"__{r} int" for r in RULES)
    return spark.createDataFrame(rows, schema), cutoffs


def bounded(table: DataFrame, rows: int) -> DataFrame:
    """A table of few rows is sent to all tasks; with more Spark plans the join."""
    return F.broadcast(table) if rows <= BROADCAST_CUTOFFS else table


def apply_quality_rules(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    stratum_col: str = "lang",
    label_col: str = "quality",
    risk: float = 0.02,
    delta: float = 0.05,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Documents (or their ``keep`` columns) with their counts, ``base_failed`` and ``kept``.

    ``base_failed``: under 10 words, or over 20 % of the words in repeated phrases of five words.
    ``kept``: false if the base rules fail or a statistic lies above the cutoff of its rule and
    stratum.  Cutoffs are fitted on all documents that pass the base rules; of those labelled 1, the
    ones whose crc32 of the id as text is no multiple of 4 are the holdout.  In a stratum without an
    acceptable setting (too few in the holdout) only the base rules reject.  Counts are made in one
    pass over the texts and written to the shared folder; a second pass judges the texts where
    ``keep`` leaves them in the result.

    A null text has no words and fails the base rules.  A null stratum is a stratum.  Rows with a
    null id or label do not count as labelled; an id labelled twice counts by its lowest label.
    Repeated rows are judged alike.  Columns of ``docs`` with the names of results are replaced.
    An empty table gives an empty table.
    """
    told = (
        labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
        .groupBy(F.col(id_col).alias("__id"))
        .agg((F.min(label_col) == 1).alias("good"))
    )
    path = scratch_path(docs.sparkSession, "text-counts")
    returned = docs.columns if keep is None else list(keep)
    again = text_col in returned
    with_stats(docs, text_col, keep=[*([] if again else returned), id_col, stratum_col]).write.parquet(path)
    counted = docs.sparkSession.read.parquet(path)
    few = counted.filter(~base_failed()).select(
        F.col(id_col).alias("__id"), F.col(stratum_col).alias("stratum"), *BASE, *(_OWN + m for m in _MORE)
    )
    held = F.coalesce(F.col("good") & (F.crc32(F.col("__id").cast("string")) % 4 != 0), F.lit(False))
    cutoffs, known = fit_cutoffs(
        few.join(told, "__id", "left").withColumn("held", held), "stratum", risk, delta
    )
    # texts are not written for this: where they are returned, they are counted again
    judged = with_stats(docs, text_col) if again else counted
    judged = judged.withColumn("base_failed", base_failed())
    judged = judged.join(
        bounded(cutoffs, len(known)), F.col(stratum_col).cast("string").eqNullSafe(F.col("__stratum")), "left"
    )
    over = F.lit(False)
    for name in RULES:
        over = over | F.coalesce(cell_of(name) > F.col(f"__{name}"), F.lit(False))
    result = judged.withColumn("kept", ~F.col("base_failed") & ~over)
    added = [c for c in (*BASE, "base_failed", "kept") if c not in returned]
    return result.select(*returned, *added)

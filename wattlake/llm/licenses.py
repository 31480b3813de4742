"""License scans: which documents contain a license notice, and where.

A text is cut into overlapping windows of word shingles.  MinHash signatures of the windows, in
bands, retrieve templates whose signature agrees in a band; the number of bands follows from the
least resemblance that a match can have, so that a match is found with the probability asked for.
A retrieved window matches if it really contains enough of the template's shingles.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from wattlake.llm.license_texts import NOTICES
from wattlake.llm.words import (
    Windows,
    Words,
    find_words,
    lower_ascii,
    runs,
    scrambled,
    sliced,
    span_hashes,
    text_bytes,
    window_hashes,
)

SHINGLE = 5

#: True for bytes of words: digits, letters and all of longer characters, no punctuation.
_OF_WORDS = np.array([chr(b).isalnum() or b >= 128 for b in range(256)])


def text_shingles(column: pa.Array) -> tuple[Words, Windows]:
    """Words without ASCII punctuation, and the hashes of all 5-word shingles with their first word
    and text."""
    data, offsets = text_bytes(column)
    data = lower_ascii(data)
    starts, ends = runs(_OF_WORDS[data], offsets)
    words = Words(data, offsets, starts, ends, np.searchsorted(starts, offsets))
    return words, window_hashes(span_hashes(data, starts, ends), words.bounds, SHINGLE)


@dataclass(frozen=True)
class Template:
    name: str
    shingles: np.ndarray

    def needed(self, share: float) -> int:
        return max(1, math.ceil(share * len(self.shingles) - 1e-9))


@dataclass(frozen=True)
class TemplateClass:
    """Templates found with windows of the same length: two blocks of ``block`` shingles."""

    block: int
    bands: int
    templates: tuple[Template, ...]

    def minima(self, salts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For every band the templates' least values in order, and whose they are."""
        found = []
        for salt in salts[: self.bands]:
            least = np.array([minhash_values(t.shingles, salt).min() for t in self.templates])
            order = np.argsort(least, kind="stable")
            found.append((least[order], order))
        return found


def _salts(count: int) -> np.ndarray:
    return scrambled(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def minhash_values(shingles: np.ndarray, salt: np.uint64) -> np.ndarray:
    return (shingles ^ salt) * np.uint64(0xFF51AFD7ED558CCD) >> np.uint64(32)


def template_classes(
    notices: Mapping[str, str], share: float, certainty: float
) -> list[TemplateClass]:
    """Templates by the length of their windows, with the bands (of one row) that each needs.

    A template of up to ``block`` shingles in a row lies within one of the windows of two blocks
    that begin at every block.  A window with ``m`` of a template's ``s`` shingles has resemblance
    ``m / (2 * block + s - m)`` or more.
    """
    grouped: dict[int, list[Template]] = {}
    for name, text in notices.items():
        _, windows = text_shingles(pa.array([text]))
        if not len(windows.hashes):
            raise ValueError(f"notice {name} has fewer than {SHINGLE} words")
        template = Template(name, np.unique(windows.hashes))
        grouped.setdefault(1 << math.ceil(math.log2(len(windows.hashes))), []).append(template)
    classes = []
    for block, templates in sorted(grouped.items()):
        least = min(
            t.needed(share) / (2 * block + len(t.shingles) - t.needed(share)) for t in templates
        )
        bands = math.ceil(math.log(1 - certainty) / math.log(1 - least))
        classes.append(TemplateClass(block, bands, tuple(templates)))
    return classes


def _blocks(bounds: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of blocks of shingles, none across texts, and the text of each."""
    count = -(-np.diff(bounds) // block)
    text = np.repeat(np.arange(len(count)), count)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    return bounds[:-1][text] + nth * block, text


def _looked_up(values: np.ndarray, keys: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of a value, owner) of all equal pairs of values and sorted keys."""
    begin = np.searchsorted(keys, values, "left")
    at = np.flatnonzero(begin < len(keys))
    at = at[keys[begin[at]] == values[at]]
    count = np.searchsorted(keys, values[at], "right") - begin[at]
    nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return np.repeat(at, count), owners[np.repeat(begin[at], count) + nth]


def scan_slice(
    column: pa.Array, classes: list[TemplateClass], share: float, tables: list | None = None
) -> list[dict]:
    """Matches in some texts: text number, template, windows, containment, first and last word.

    ``tables`` are the templates' minima by class, where they are known already.
    """
    words, found = text_shingles(column)
    hashes = found.hashes
    if not len(hashes):
        return []
    bounds = np.searchsorted(found.text, np.arange(len(words.bounds)))
    salts = _salts(max(c.bands for c in classes))
    if tables is None:
        tables = [c.minima(salts) for c in classes]
    blocks = [_blocks(bounds, c.block) for c in classes]
    candidates: list[list[np.ndarray]] = [[] for _ in classes]
    for number, salt in enumerate(salts):
        values = minhash_values(hashes, salt)
        for k, c in enumerate(classes):
            if number >= c.bands:
                continue
            starts, text = blocks[k]
            least = np.minimum.reduceat(values, starts)
            # a window is a block and the next one of the same text
            both = least.copy()
            same = text[1:] == text[:-1]
            both[:-1][same] = np.minimum(least[:-1], least[1:])[same]
            window, template = _looked_up(both, *tables[k][number])
            if len(window):
                candidates[k].append(template * len(both) + window)
    # positions are told in words between white space
    spaced = find_words(words.data, words.offsets)
    place = np.searchsorted(spaced.starts, words.starts, "right") - 1
    rows: dict = {}
    for c, hits, (starts, text) in zip(classes, candidates, blocks, strict=True):
        for hit in np.unique(np.concatenate(hits)) if hits else ():
            t, window = divmod(int(hit), len(starts))
            template = c.templates[t]
            begin = starts[window]
            end = min(begin + 2 * c.block, bounds[text[window] + 1])
            inside = np.isin(hashes[begin:end], template.shingles)
            common = len(np.unique(hashes[begin:end][inside]))
            if common < template.needed(share):
                continue
            at = found.first[begin:end][inside]
            base = spaced.bounds[text[window]]
            row = rows.setdefault((int(text[window]), template.name), [0, 0.0, 1 << 62, -1])
            row[0] += 1
            row[1] = max(row[1], common / len(template.shingles))
            row[2] = min(row[2], int(place[at[0]] - base))
            row[3] = max(row[3], int(place[at[-1] + SHINGLE - 1] - base))
    names = ("text", "license", "n_windows", "containment", "first_word", "last_word")
    return [dict(zip(names, (*key, *row), strict=True)) for key, row in rows.items()]


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    notices: Mapping[str, str] = NOTICES,
    share: float = 0.75,
    certainty: float = 0.9999,
) -> DataFrame:
    """One row per document and license found in it: id, ``license``, ``n_windows`` (matching
    windows), ``containment`` (the best window's share of the notice's shingles), ``first_word``
    and ``last_word`` (numbers of the first and last word matched).

    Words are compared in lower case (A-Z) and without ASCII punctuation, which parts them, in
    shingles of five.  Word numbers count words between white space.  A window matches if it contains
    at least ``share`` of a notice's shingles; one that does is found with probability
    ``certainty`` or more.  A text that is null, empty or shorter than five words matches nothing.
    Repeated rows are reported each; other columns are not returned.  The notices travel with the
    job: they are a parameter, not data that grows.  An empty table gives an empty table.
    """
    classes = template_classes(notices, share, certainty)
    tables = [c.minima(_salts(c.bands)) for c in classes]
    schema = StructType([docs.schema[id_col]])
    for name, kind in (
        ("license", "string"), ("n_windows", "long"), ("containment", "double"),
        ("first_word", "long"), ("last_word", "long"),
    ):
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, text_col):
                rows = scan_slice(part.column(text_col), classes, share, tables)
                if not rows:
                    continue
                table = pa.Table.from_pylist(rows)
                ids = part.column(id_col).take(table.column("text").combine_chunks())
                yield pa.RecordBatch.from_arrays(
                    [ids, *(table.column(n).combine_chunks() for n in schema.names[1:])],
                    names=schema.names,
                )

    return docs.select(id_col, text_col).mapInArrow(run, schema)

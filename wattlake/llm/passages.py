"""Substring dedup: passages that an earlier document has already.

Every window of fixed length is hashed by Rabin-Karp, and the hashes are brought together in
Spark in buckets.  A batch of documents sends each window once, in arrays per bucket, so that a
passage shared by a third of all documents costs a bucket one entry per batch.  The bucket of a
window comes from a second, independent hash: two different windows are confused only if 64 bits
and the bucket agree.  The answers, again in arrays, meet the texts in parts of the table, small
enough for a task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructType

from wattlake.llm.frames import exchange_buckets
from wattlake.llm.words import (
    FIRST_BASE,
    SECOND_BASE,
    covered,
    find_words,
    per_text,
    release_memory,
    releasing,
    releasing_pair,
    sliced,
    span_hashes,
    text_bytes,
    window_hashes,
)

_MESSAGE = pa.schema(
    [("bucket", pa.int32()), ("known", pa.bool_()), ("docs", pa.binary()), ("counts", pa.binary()), ("hashes", pa.binary())]
)
_FOUND = pa.schema([("part", pa.int32()), ("docs", pa.binary()), ("counts", pa.binary()), ("hashes", pa.binary())])


def _runs(sorted_values: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]]))


def _message(bucket: int, known: bool, docs: np.ndarray, hashes: np.ndarray) -> dict:
    """One row: documents in order, how many hashes each has, and the hashes."""
    begin = _runs(docs)
    counts = np.diff(np.append(begin, len(docs))).astype(np.int32)
    return {
        "bucket": bucket, "known": known, "docs": docs[begin].tobytes(),
        "counts": counts.tobytes(), "hashes": hashes.tobytes(),
    }


def _windows_to_buckets(window: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            release_memory()
            batch = batch.filter(batch.column("doc").is_valid())
            for part in sliced(batch, "text"):
                part = part.sort_by("doc")
                docs = np.asarray(part.column("doc"), np.int64)
                words = find_words(*text_bytes(part.column("text")))
                named = span_hashes(words.data, words.starts, words.ends)
                found = window_hashes(named, words.bounds, window, FIRST_BASE)
                if not len(found.hashes):
                    continue
                bucket = window_hashes(named, words.bounds, window, SECOND_BASE).hashes % np.uint64(buckets)
                # a stable sort leaves the smallest document first among equal windows
                order = np.argsort(found.hashes, kind="stable")
                hashes, doc, bucket = found.hashes[order], docs[found.text[order]], bucket[order]
                begin = _runs(hashes)
                size = np.diff(np.append(begin, len(hashes)))
                later = np.flatnonzero(doc > np.repeat(doc[begin], size))
                rows = []
                if len(later):
                    by_doc = later[np.argsort(doc[later], kind="stable")]
                    rows.append(_message(int(bucket[later[0]]), True, doc[by_doc], hashes[by_doc]))
                first = begin[np.lexsort((doc[begin], bucket[begin]))]
                edges = _runs(bucket[first])
                for a, b in zip(edges, np.append(edges[1:], len(first)), strict=True):
                    one = first[a:b]
                    rows.append(_message(int(bucket[one[0]]), False, doc[one], hashes[one]))
                yield pa.RecordBatch.from_pylist(rows, schema=_MESSAGE)

    return run


def _unpacked(row: dict) -> tuple[np.ndarray, np.ndarray]:
    docs = np.frombuffer(row["docs"], np.int64)
    return np.repeat(docs, np.frombuffer(row["counts"], np.int32)), np.frombuffer(row["hashes"], np.uint64)


def part_of(id_col: str, text_col: str, parts: int):
    """The part of the table a document belongs to; rows without id go by their text."""
    name = F.coalesce(F.col(id_col).cast("string"), F.col(text_col), F.lit(""))
    return F.pmod(F.crc32(name), F.lit(parts)).cast("int")


def _by_part(docs: np.ndarray, hashes: np.ndarray, parts: int) -> Iterator[dict]:
    if not len(docs):
        return
    names, at = np.unique(docs, return_inverse=True)
    part = np.array([zlib.crc32(str(d).encode()) % parts for d in names.tolist()])[at]
    order = np.lexsort((docs, part))
    begin = _runs(part[order])
    for a, b in zip(begin, np.append(begin[1:], len(order)), strict=True):
        mine = order[a:b]
        row = _message(0, True, docs[mine], hashes[mine])
        yield {"part": int(part[mine[0]]), **{k: row[k] for k in ("docs", "counts", "hashes")}}


def _repeated(parts: int):
    def run(table: pa.Table) -> pa.Table:
        """The windows of this bucket that documents with a smaller id have as well, in arrays
        per part of the documents."""
        docs, hashes, known_docs, known_hashes = [], [], [], []
        for message in table.to_pylist():
            doc, found = _unpacked(message)
            (known_docs if message["known"] else docs).append(doc)
            (known_hashes if message["known"] else hashes).append(found)
        if docs:
            doc, found = np.concatenate(docs), np.concatenate(hashes)
            order = np.argsort(found, kind="stable")
            doc, found = doc[order], found[order]
            begin = _runs(found)
            least = np.repeat(np.minimum.reduceat(doc, begin), np.diff(np.append(begin, len(doc))))
            known_docs.append(doc[doc > least])
            known_hashes.append(found[doc > least])
        rows = list(_by_part(np.concatenate(known_docs), np.concatenate(known_hashes), parts)) if known_docs else []
        return pa.Table.from_pylist(rows, schema=_FOUND)

    return run


def repeated_windows(docs: DataFrame, id_col: str, text_col: str, window: int, parts: int) -> DataFrame:
    """(part, docs, counts, hashes): the documents of a part, and the hashes of their windows that
    begin in a document with a smaller id as well, in arrays; several rows per part."""
    plain = docs.select(
        F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text")
    )
    messages = plain.mapInArrow(
        _windows_to_buckets(window, parts),
        "bucket int, known boolean, docs binary, counts binary, hashes binary",
    )
    return messages.groupBy("bucket").applyInArrow(
        releasing(_repeated(parts)), "part int, docs binary, counts binary, hashes binary"
    )


def _cut(part: pa.RecordBatch, id_col: str, text_col: str, window: int, found: tuple, rejoin_all: bool) -> dict:
    """The texts of a slice without their repeated windows, and the words they had and lost."""
    known, begin, end, sought = found
    words = find_words(*text_bytes(part.column(text_col)))
    ids = part.column(id_col).cast(pa.int64())
    at = np.searchsorted(known, np.asarray(ids.fill_null(0)))
    hit = np.flatnonzero(np.asarray(ids.is_valid()) & (np.append(known, 0)[at] == np.asarray(ids.fill_null(0))) & (at < len(known)))
    gone = np.zeros(len(words.starts), bool)
    if len(hit):
        named = span_hashes(words.data, words.starts, words.ends)
        windows = window_hashes(named, words.bounds, window, FIRST_BASE)
        bounds = np.searchsorted(windows.text, np.arange(len(words.bounds)))
        chosen = []
        for d in hit:
            mine = slice(bounds[d], bounds[d + 1])
            repeated = np.isin(windows.hashes[mine], sought[begin[at[d]] : end[at[d]]])
            chosen.append(windows.first[mine][repeated])
        gone = covered(np.concatenate(chosen), window, len(gone))
    removed = per_text(gone, words.bounds)
    texts = part.column(text_col).cast(pa.binary()).to_pylist()
    for d in np.flatnonzero(removed) if not rejoin_all else range(len(texts)):
        pieces = (texts[d] or b"").split()
        if removed[d]:
            keep = ~gone[words.bounds[d] : words.bounds[d + 1]]
            pieces = [pieces[i] for i in np.flatnonzero(keep)]
        texts[d] = b" ".join(pieces)
    return {text_col: texts, "n_words": np.diff(words.bounds), "n_removed": removed}


def remove_repeated_passages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = 50,
    rejoin_all: bool = False,
) -> DataFrame:
    """Texts without the words that an earlier document has in the same window of ``window`` words.

    A window counts as repeated if its words also begin somewhere in a document with a smaller
    id; overlapping and adjacent repeated windows form one interval, and all its words go.
    Windows are judged on the input, not on what is left of earlier documents.

    Returns all columns of ``docs``, the text replaced by the kept words joined by one space, and
    ``n_words`` and ``n_removed``; a column of that name in ``docs`` is replaced.  A text that
    loses nothing stays as it is, unless ``rejoin_all``.  A null text stays null (empty with
    ``rejoin_all``) with 0 words.  A row with a null id neither loses words nor makes others lose
    them.  Rows with the same id are one document here: they never repeat each other, and what
    is repeated in one of them goes from all.  An empty table gives an empty table.
    """
    parts = exchange_buckets(docs)
    found = repeated_windows(docs, id_col, text_col, window, parts)
    added = {"n_words": LongType(), "n_removed": LongType()}
    schema = StructType([f for f in docs.schema.fields if f.name not in added])
    for name, kind in added.items():
        schema = schema.add(name, kind)
    arrow = to_arrow_schema(schema)

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        messages = [_unpacked(m) for m in right.to_pylist()]
        known = np.concatenate([m[0] for m in messages] or [np.zeros(0, np.int64)])
        hashes = np.concatenate([m[1] for m in messages] or [np.zeros(0, np.uint64)])
        order = np.argsort(known, kind="stable")
        names, begin = np.unique(known[order], return_index=True)
        looked_up = names, begin, np.append(begin[1:], len(known)), hashes[order]
        done = []
        for batch in left.to_batches():
            for part in sliced(batch, text_col):
                new = _cut(part, id_col, text_col, window, looked_up, rejoin_all)
                done.append(pa.RecordBatch.from_arrays(
                    [
                        pa.array(new[f.name], pa.binary()).cast(f.type) if f.name == text_col
                        else pa.array(new[f.name], f.type) if f.name in new
                        else part.column(f.name).cast(f.type)
                        for f in arrow
                    ],
                    schema=arrow,
                ))
        return pa.Table.from_batches(done, arrow)

    parted = docs.withColumn("__part", part_of(id_col, text_col, parts))
    result = (
        parted.groupBy("__part").cogroup(found.groupBy("part")).applyInArrow(releasing_pair(cut), schema)
    )
    return result.select(*docs.columns, *(c for c in added if c not in docs.columns))

"""N-gram Jaccard join: documents whose sets of word shingles resemble each other.

A pair is linked if ``100 * |A and B| >= percent * |A or B|``.  Links are found by T-occurrence
search: a partner of a document with n shingles has at least ``T = ceil(percent/100 * n)`` of them,
so it occurs T times in the inverted lists of the document's shingles.

1. *Lists.*  Batches of documents send their shingle hashes, in arrays per bucket, to where all
   occurrences of a shingle meet, and get back which of them other documents have, and how many.
   Shingles in a thousandth of a sample of documents or more are not sent: they are the longest
   lists, known to all tasks, and a document just counts its own.  A document without T shared
   or very frequent shingles has no partner and drops out.
2. *Groups.*  In the order of list length, two linked documents have a common shingle among the
   first ``shared - T + 1`` of each (prefix filter).  Documents connected by such shingles form
   groups; a group holds all partners of its documents.
3. *Search.*  A task indexes the documents of a group, or of two blocks of a large one, and
   searches each document by DivideSkip: short lists are merged and counted, the few longest only
   probed by binary search for the candidates that can still reach T.

Documents with equal shingle sets are one node from step 2 on, so copies are never paired.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattlake.llm.components import connected_components
from wattlake.llm.frames import exchange_buckets
from wattlake.llm.words import (
    find_words,
    lower_ascii,
    release_memory,
    releasing,
    scrambled,
    sliced,
    span_hashes,
    text_bytes,
    window_hashes,
)
from wattlake.session import scratch_path

#: Of the documents whose ids decide which shingles count as very frequent, one in so many.
SAMPLED = 64
#: At most so many shingles are treated as very frequent (8 bytes each in every task).
MOST_FREQUENT = 1 << 19
#: Documents of a group searched together, and the number of blocks a group is cut into before
#: blocks grow; and the shingles of a block at most.
BLOCK_DOCS, BLOCKS, BLOCK_SHINGLES = 80, 32, 1 << 21


def least_overlap(n, percent: int):
    """The shingles that a partner of a set of n has in common with it, at least."""
    return -(-n * percent // 100)


def linked(common, n, m, percent: int):
    return 100 * common >= percent * (n + m - common)


def shingle_sets(column: pa.Array, size: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its shingles; a shorter text is one shingle."""
    data, offsets = text_bytes(column)
    words = find_words(lower_ascii(data), offsets)
    hashes = span_hashes(words.data, words.starts, words.ends)
    found = window_hashes(hashes, words.bounds, size)
    bounds = np.searchsorted(found.text, np.arange(len(words.bounds)))
    sets = [np.unique(found.hashes[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    counts = np.diff(words.bounds)
    for d in np.flatnonzero((counts > 0) & (counts < size)):
        few = np.uint64(0)
        for h in hashes[words.bounds[d] : words.bounds[d + 1]]:
            few = scrambled(np.array([few ^ h]) + np.uint64(counts[d]))[0]
        sets[d] = np.array([few], np.uint64)
    return sets


def set_key(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _signatures(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            release_memory()
            for part in sliced(batch, "text"):
                sets = shingle_sets(part.column("text"), size)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([set_key(s) if len(s) else None for s in sets], pa.binary()),
                    ],
                    names=["doc", "n", "key"],
                )

    return run


def frequent_shingles(plain: DataFrame, size: int) -> np.ndarray:
    """Sorted hashes of shingles in at least a thousandth, and 8, of the sampled sets.

    Any choice gives the same links; this one keeps very long lists out of the exchange.  There
    are at most 1000 times as many as an average set has, and ``MOST_FREQUENT`` at most.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            release_memory()
            for part in sliced(batch, "text"):
                sets = {set_key(s): s for s in shingle_sets(part.column("text"), size)}
                keys = np.array([int.from_bytes(k[:8], "big", signed=True) for k in sets], np.int64)
                lengths = [len(s) for s in sets.values()]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([*sets.values(), np.zeros(0, np.uint64)]).view(np.int64)),
                        pa.array(np.repeat(keys, lengths)),
                    ],
                    names=["hash", "key"],
                )

    sample = plain.filter(F.pmod(F.xxhash64("doc"), F.lit(SAMPLED)) == 0)
    least = max(8, sample.count() // 1000)
    rows = (
        sample.mapInArrow(run, "hash long, key long").distinct()
        .groupBy("hash").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)
        .orderBy(F.desc("n"), "hash").limit(MOST_FREQUENT).collect()
    )
    return np.sort(np.array([r["hash"] for r in rows], np.int64).view(np.uint64))


# Rows of the exchange: from a batch to a bucket and back.  A directory row has the keys, sizes
# and very frequent shingles of a batch's sets; the others have hashes with the number of the set.
_EXCHANGE = "bucket int, slice long, keys binary, sizes binary, hashes binary, sets binary, counts binary"


def _row(bucket: int, name: int, **values) -> dict:
    empty = dict.fromkeys(("keys", "sizes", "hashes", "sets", "counts"), b"")
    return {"bucket": bucket, "slice": name} | empty | {k: v.tobytes() for k, v in values.items()}


def _arrow(schema: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in schema.split(", ")])


def _shingles_to_buckets(size: int, buckets: int, frequent: np.ndarray):
    schema = _arrow(_EXCHANGE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            release_memory()
            for part in sliced(batch, "text"):
                found = {set_key(s): s for s in shingle_sets(part.column("text"), size) if len(s)}
                if not found:
                    continue
                keys, sets = np.frombuffer(b"".join(found), np.uint8), list(found.values())
                name = int.from_bytes(hashlib.blake2b(keys.tobytes(), digest_size=8).digest(), "big") >> 1
                lengths = np.array([len(s) for s in sets])
                hashes, of = np.concatenate(sets), np.repeat(np.arange(len(sets)), lengths).astype(np.uint16)
                place = np.searchsorted(frequent, hashes)
                often = np.zeros(len(hashes), bool)
                if len(frequent):
                    often = frequent[np.minimum(place, len(frequent) - 1)] == hashes
                rows = [
                    _row(
                        name % buckets, name, keys=keys, sizes=lengths.astype(np.uint32),
                        hashes=place[often].astype(np.uint32), sets=of[often],
                    )
                ]
                hashes, of = hashes[~often], of[~often]
                # the upper bits choose the bucket: lower ones may be all that some sets differ in
                bucket = ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
                order = np.argsort(bucket, kind="stable")
                edges = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=buckets))
                for a, b in zip(edges[:-1], edges[1:], strict=True):
                    mine = order[a:b]
                    rows.append(_row(int(bucket[mine[0]]), name, hashes=hashes[mine], sets=of[mine]))
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return run


def _count_lists(table: pa.Table) -> pa.Table:
    """Of a bucket: each batch's shingles that occur in another set, and in how many."""
    messages = table.to_pylist()
    rows = [m for m in messages if m["keys"]]
    sent = [m for m in messages if not m["keys"]]
    if sent:
        hashes = np.concatenate([np.frombuffer(m["hashes"], np.uint64) for m in sent])
        order = np.argsort(hashes, kind="stable")
        ordered = hashes[order]
        begin = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        length = np.diff(np.append(begin, len(ordered)))
        count = np.empty(len(hashes), np.int64)
        count[order] = np.repeat(length, length)
        at = 0
        for m in sent:
            end = at + len(m["hashes"]) // 8
            shared = count[at:end] > 1
            if shared.any():
                of = np.frombuffer(m["sets"], np.uint16)
                rows.append(
                    _row(
                        m["bucket"], m["slice"], hashes=hashes[at:end][shared], sets=of[shared],
                        counts=np.minimum(count[at:end][shared], 0xFFFFFFFF).astype(np.uint32),
                    )
                )
            at = end
    return pa.Table.from_pylist(rows, schema=_arrow(_EXCHANGE))


_CANDIDATE = "key binary, n long, shingles binary, prefix long"


def _candidates(percent: int, frequent: np.ndarray):
    """Of a batch: the sets that can have a partner, their shingles by list length."""

    def run(table: pa.Table) -> pa.Table:
        messages = table.to_pylist()
        heads = [m for m in messages if m["keys"]]
        rows = []
        if heads:
            head = heads[0]  # equal batches have equal heads
            sizes = np.frombuffer(head["sizes"], np.uint32).astype(np.int64)
            hashes = [frequent[np.frombuffer(head["hashes"], np.uint32)]]
            of = [np.frombuffer(head["sets"], np.uint16)]
            counts = [np.full(len(of[0]), 1 << 40)]
            for m in messages:
                if not m["keys"]:
                    hashes.append(np.frombuffer(m["hashes"], np.uint64))
                    of.append(np.frombuffer(m["sets"], np.uint16))
                    counts.append(np.frombuffer(m["counts"], np.uint32).astype(np.int64))
            hashes, of, counts = map(np.concatenate, (hashes, of, counts))
            order = np.lexsort((hashes, counts, of))
            hashes, of = hashes[order], of[order]
            bounds = np.searchsorted(of, np.arange(len(sizes) + 1))
            for s in np.flatnonzero(np.diff(bounds) >= least_overlap(sizes, percent)):
                mine = hashes[bounds[s] : bounds[s + 1]]
                if len(heads) > 1:
                    _, first = np.unique(mine, return_index=True)
                    mine = mine[np.sort(first)]
                prefix = len(mine) - least_overlap(int(sizes[s]), percent) + 1
                if prefix > 0:
                    rows.append({
                        "key": head["keys"][16 * s : 16 * s + 16], "n": int(sizes[s]),
                        "shingles": mine.tobytes(), "prefix": prefix,
                    })
        return pa.Table.from_pylist(rows, schema=_arrow(_CANDIDATE))

    return run


def _prefix_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch: edges (without shingle) from each node to the smallest one that common prefix
    shingles connect it with in the batch, and that smallest node of each prefix shingle."""
    for batch in batches:
        release_memory()
        for at in range(0, batch.num_rows, 2048):
            part = batch.slice(at, 2048)
            nodes = np.asarray(part.column("node"), np.int64)
            prefixes = np.asarray(part.column("prefix"), np.int64)
            shingles = [
                np.frombuffer(s.as_buffer(), np.uint64)[:p]
                for s, p in zip(part.column("shingles"), prefixes, strict=True)
            ]
            hashes = np.concatenate(shingles)
            owner = np.repeat(np.arange(len(nodes)), [len(s) for s in shingles])
            order = np.argsort(hashes, kind="stable")
            hashes, owner = hashes[order], owner[order]
            begin = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
            length = np.diff(np.append(begin, len(hashes)))
            least, before = nodes.copy(), None
            while before is None or (least != before).any():
                before = least.copy()
                lead = np.minimum.reduceat(least[owner], begin)
                np.minimum.at(least, owner, np.repeat(lead, length))
            other = least != nodes
            none = pa.nulls(int(other.sum()), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [none, pa.array(nodes[other]), pa.array(least[other])], names=["hash", "a", "b"]
            )
            first = pa.array(lead)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes[begin].view(np.int64)), first, first], names=["hash", "a", "b"]
            )


def _merged(posting: np.ndarray, begin: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The members of sorted lists in order, and in how many of the lists each is.

    The lists are laid end to end and put in order together: one pass for all, whose work follows
    the lists and not the number of sets.
    """
    count = ends - begin
    at = np.arange(count.sum()) + np.repeat(begin - (np.cumsum(count) - count), count)
    stream = np.sort(posting[at], kind="stable")
    if not len(stream):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], stream[1:] != stream[:-1]]))
    return stream[first].astype(np.int64), np.diff(np.append(first, len(stream)))


def search_block(
    sets: list[np.ndarray], sizes: np.ndarray, side: np.ndarray, percent: int, weight: float = 0.05
) -> Iterator[tuple[int, np.ndarray]]:
    """Yields (query, its later partners) by DivideSkip over the sets' inverted lists.

    ``sets`` hold shared shingles only, ``sizes`` count all.  With two sides, only pairs across
    them are searched.
    """
    two_sides = side.any()
    lengths = [len(s) for s in sets]
    hashes, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), lengths)
    order = np.lexsort((owner, hashes))
    # the narrowest type, so that short numbers are sorted by their bytes
    names, posting = hashes[order], owner[order].astype(np.min_scalar_type(len(sets)))
    begin = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]]))
    ends = np.append(begin[1:], len(names))
    names = names[begin]
    # place in the order of (list, set), to cut lists at a set
    ranks = np.repeat(np.arange(len(names)), ends - begin) * len(sets) + posting
    for q, mine in enumerate(sets):
        place = np.searchsorted(names, mine)
        size = ends[place] - begin[place]
        place = place[np.argsort(size, kind="stable")]
        needed = int(least_overlap(int(sizes[q]), percent))
        # DivideSkip's choice of how many of the longest lists to leave out of the merge
        longest = max(2, int(size.max(initial=2)))
        skipped = min(needed - 1, int(needed / (weight * math.log2(longest) + 1)), len(place) - 1)
        merged = place[: len(place) - skipped]
        found, common = _merged(posting, np.searchsorted(ranks, merged * len(sets) + q, "right"), ends[merged])
        fits = common >= needed - skipped
        if two_sides:
            fits &= side[found] != side[q]
        found, common = found[fits], common[fits]
        if not len(found):
            continue
        for p in place[len(place) - skipped :]:
            whole = posting[begin[p] : ends[p]]
            at = np.minimum(np.searchsorted(whole, found), len(whole) - 1)
            common = common + (whole[at] == found)
        good = found[linked(common, sizes[q], sizes[found], percent)]
        if len(good):
            yield q, good


_LINKS = "node long, partner long, links long"


def _search(percent: int):
    def run(table: pa.Table) -> pa.Table:
        """Partners counted per node, and each node tied to the smallest one that links reach here."""
        table = table.sort_by([("n", "ascending"), ("node", "ascending")])
        nodes = np.asarray(table.column("node"), np.int64)
        sizes = np.asarray(table.column("n"), np.int64)
        copies = np.asarray(table.column("copies"), np.int64)
        side = (np.asarray(table.column("block")) != table.column("low")[0].as_py()).astype(int)
        if table.column("low")[0].as_py() != table.column("high")[0].as_py() and not side.any():
            return _arrow(_LINKS).empty_table()
        sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in table.column("shingles").combine_chunks()]
        links = np.zeros(len(nodes), np.int64)
        parent = list(range(len(nodes)))

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for q, partners in search_block(sets, sizes, side, percent):
            links[q] += copies[partners].sum()
            links[partners] += copies[q]
            for p in partners.tolist():
                parent[root(q)] = root(p)
        some = np.flatnonzero(links)
        tops = np.array([root(x) for x in some.tolist()], np.int64)
        least = np.full(len(nodes), np.iinfo(np.int64).max)
        np.minimum.at(least, tops, nodes[some])
        tied = nodes[some] != least[tops]
        return pa.table(
            [
                np.concatenate([nodes[some], nodes[some][tied]]),
                np.concatenate([nodes[some], least[tops][tied]]),
                np.concatenate([links[some], np.zeros(int(tied.sum()), np.int64)]),
            ],
            schema=_arrow(_LINKS),
        )

    return run


def _units(candidates: DataFrame, groups: DataFrame) -> DataFrame:
    """Candidates with the pairs of blocks (low, high) of their group that they belong to."""
    placed = candidates.join(groups, "node")
    sizes = placed.groupBy("component").agg(
        F.count(F.lit(1)).alias("docs"), F.sum(F.length("shingles") / 8).alias("shingles_in")
    )
    blocks = F.greatest(
        F.least(F.lit(BLOCKS), F.ceil(F.col("docs") / BLOCK_DOCS)),
        F.ceil(F.col("shingles_in") / BLOCK_SHINGLES),
    )
    # a search takes far longer than its bytes suggest: do not let small partitions be merged
    tasks = 4 * int(candidates.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        placed.join(sizes.select("component", blocks.cast("int").alias("blocks")), "component")
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "component", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
            "block", "node", "n", "copies", "shingles",
        )
        .repartition(tasks, "component", "low", "high")
    )


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 75
) -> DataFrame:
    """(id, ``n_shingles``, ``component_id``, ``n_links``), one row per row of ``docs``.

    Words are runs of bytes other than ASCII white space, A-Z in lower case; a document's set has
    its distinct shingles of ``size`` words, or its whole sequence if it has fewer words.
    Documents are linked if ``100 * common >= percent * united``.  ``component_id`` is the smallest
    id reachable by links, itself included; ``n_links`` is the number of other rows linked
    directly, copies included.

    A text that is null, empty or without words has no shingles and no links.  A row with a null
    id takes no part and has a null component.  Rows with the same id are one document as far as
    components go.  Other columns are not returned.  An empty table gives an empty table.
    """
    spark = docs.sparkSession
    plain = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    root = scratch_path(spark, "ngram-join")

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{root}/{name}")
        return spark.read.schema(df.schema).parquet(f"{root}/{name}")

    sets = written(plain.mapInArrow(_signatures(size), "doc long, n long, key binary"), "sets")
    usable = sets.filter(F.col("key").isNotNull() & F.col("doc").isNotNull())
    classes = usable.groupBy("key").agg(F.min("doc").alias("node"), F.count(F.lit(1)).alias("copies"))

    known = plain.filter(F.col("doc").isNotNull())
    frequent = frequent_shingles(known, size)
    buckets = exchange_buckets(plain)
    lists = (
        known.mapInArrow(_shingles_to_buckets(size, buckets, frequent), _EXCHANGE)
        .groupBy("bucket").applyInArrow(releasing(_count_lists), _EXCHANGE)
    )
    found = lists.groupBy("slice").applyInArrow(releasing(_candidates(percent, frequent)), _CANDIDATE)
    candidates = written(
        found.dropDuplicates(["key"]).join(classes, "key").select("node", "n", "copies", "shingles", "prefix"),
        "candidates",
    )
    stars = written(
        candidates.select("node", "shingles", "prefix").mapInArrow(_prefix_stars, "hash long, a long, b long"),
        "stars",
    )
    leads = stars.filter(F.col("hash").isNotNull())
    least = leads.groupBy("hash").agg(F.min("a").alias("b"))
    edges = (
        stars.filter(F.col("hash").isNull()).select("a", "b")
        .unionByName(leads.select("hash", "a").join(least, "hash").select("a", "b"))
        .filter("a <> b").distinct()
    )
    links = written(
        _units(candidates, connected_components(edges))
        .groupBy("component", "low", "high").applyInArrow(releasing(_search(percent)), _LINKS),
        "links",
    )
    # a row that links a node to itself carries its number of partners
    partners = links.groupBy("node").agg(F.sum("links").alias("links"))
    ties = links.filter("node <> partner").select(F.col("node").alias("a"), F.col("partner").alias("b"))
    # rows that share an id tie their sets together; usually there are none
    repeated = usable.groupBy("doc").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").select("doc")
    tied = usable.join(repeated, "doc").join(classes, "key").select("doc", "node")
    first = tied.groupBy("doc").agg(F.min("node").alias("b"))
    same_id = tied.join(first, "doc").select(F.col("node").alias("a"), "b").filter("a <> b")
    components = connected_components(ties.unionByName(same_id))
    answer = (
        classes.join(components, "node", "left").join(partners, "node", "left")
        .select(
            F.col("key").alias("__key"),
            F.coalesce("component", "node").alias("component"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
        )
    )
    usable_row = F.col("doc").isNotNull()
    return sets.join(answer, usable_row & (F.col("key") == F.col("__key")), "left").select(
        F.col("doc").cast(docs.schema[id_col].dataType).alias(id_col),
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "doc").alias("component_id"),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
    )

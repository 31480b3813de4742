"""Operators on documents against plain versions, and their defined results in odd cases."""

import collections
import hashlib
import math
import os
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import components, prose, shingles, varied, without_repeats, words
from pyspark.sql import functions as F

from wattlake.llm import (
    language,
    licenses,
    ngram_join,
    packing,
    passages,
    pieces,
    quality_model,
    quality_rules,
    text_stats,
)
from wattlake.llm.components import connected_components

SF = "/root/testdata/sf0.01"
data = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")

ODD = [
    (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "one"), (5, "Üñï 漢字 😀\nwords"),
    (6, "x " * 30_000), (7, "same text here"), (7, "same text here"), (None, "no id at all"),
]
DOCS = "doc_id long, text string"
#: Columns named like those that operators make or use.
CLASH = {
    "n_words": -1, "score": -1.0, "kept": "k", "bucket": 1, "slice": 2, "key": "k", "node": 3, "hash": "h",
    "n_removed": -2, "predicted": 9, "lang_pred": "zz", "n_lines": -7, "n_tokens": -3, "ids": "i", "piece": 5,
}


def frame(spark, rows, clash=False):
    df = spark.createDataFrame(rows, DOCS)
    return df.withColumns({k: F.lit(v) for k, v in CLASH.items()}) if clash else df


def corpus(seed=3):
    """Near and exact copies, chains of copies, shared passages and unrelated texts."""
    rows, common = [], prose(0, 70)
    for group in range(12):
        base = prose(100 + group, 60 + 20 * group)
        for copy in range(6):
            rows.append(varied(base, seed * 1000 + copy + 10 * group, copy))
        rows.append(base)
    rows += [common + prose(i, 5) for i in range(20)] + [prose(i, 40) + common + prose(-i, 9) for i in range(20)]
    rows += [prose(500 + i, i) for i in range(8)] + [["Same", "few"], ["same", "FEW"], ["same"], []]
    random.Random(seed).shuffle(rows)
    return [(i, "\n".join([" ".join(t[:7]), "  ".join(t[7:])])) for i, t in enumerate(rows)]


# --- words and windows -------------------------------------------------------------------------


def test_counts_of_a_text_match_a_plain_count():
    texts = [t for _, t in corpus()] + ["a b\na b\n\n \nc", "#x $$ <p>|", "é é é é é é é", "", None]

    got = text_stats.text_stats(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        found = words(text)
        lines, seen, again = (text or "").split("\n"), set(), 0
        for line in lines:
            again += bool(words(line)) and line in seen
            seen.add(line)
        windows = [tuple(found[k : k + 5]) for k in range(len(found) - 4)]
        counts = collections.Counter(windows)
        repeated = {k + j for k, w in enumerate(windows) if counts[w] > 1 for j in range(5)}
        expected = (
            len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text or ""), again, len(repeated),
        )
        assert tuple(int(got[k][i]) for k in quality_rules.BASE) == expected, text


# --- substring dedup ---------------------------------------------------------------------------


@pytest.mark.parametrize("window", [1, 7, 50])
def test_repeated_passages_go(spark, window):
    rows = corpus()
    got = passages.remove_repeated_passages(frame(spark, rows), window=window, rejoin_all=True).collect()
    expected = without_repeats(rows, window)
    assert len(got) == len(rows)
    for r in got:
        count, removed, kept = expected[r["doc_id"]]
        assert (r["n_words"], r["n_removed"], r["text"]) == (count, removed, " ".join(kept))


def test_passages_of_odd_rows(spark):
    shared = " ".join(prose(1, 60))
    rows = [*ODD, (20, shared), (20, shared), (21, shared + " end"), (None, shared)]
    got = passages.remove_repeated_passages(frame(spark, rows, clash=True), window=50)
    assert set(got.columns) == {"doc_id", "text", *CLASH}
    result = collections.defaultdict(list)
    for r in got.collect():
        result[r["doc_id"]].append((r["text"], r["n_words"], r["n_removed"]))
    assert result[1] == [(None, 0, 0)] and result[2] == [("", 0, 0)]
    assert result[7] == [("same text here", 3, 0)] * 2
    assert result[20] == [(shared, 60, 0)] * 2
    assert result[21] == [("end", 61, 60)]
    assert sorted(result[None]) == sorted([("no id at all", 4, 0), (shared, 60, 0)])
    assert passages.remove_repeated_passages(frame(spark, [])).count() == 0


# --- n-gram Jaccard join -----------------------------------------------------------------------


@pytest.mark.parametrize("blocks", [False, True])
def test_components_match_all_pairs(spark, monkeypatch, blocks):
    if blocks:  # large groups in several blocks, and very frequent shingles kept out
        monkeypatch.setattr(ngram_join, "BLOCK_DOCS", 3)
        monkeypatch.setattr(ngram_join, "SAMPLED", 1)
    rows = corpus()
    got = ngram_join.jaccard_components(frame(spark, rows)).collect()
    expected = components(rows)
    assert len(got) == len(rows)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["n_links"]) for r in got} == expected
    assert any(c != i for i, (_, c, _) in expected.items())


def test_very_frequent_shingles_are_found(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "SAMPLED", 1)
    plain = frame(spark, corpus()).select(F.col("doc_id").alias("doc"), "text")
    assert len(ngram_join.frequent_shingles(plain, 5)) >= 60


def test_components_of_odd_rows(spark):
    long = " ".join(prose(9, 100))
    rows = [*ODD, (30, long), (31, long), (30, "other words of the same id"), (32, "other words of the same id")]
    got = ngram_join.jaccard_components(frame(spark, rows, clash=True)).collect()
    result = collections.defaultdict(set)
    for r in got:
        result[r["doc_id"]].add((r["n_shingles"], r["component_id"], r["n_links"]))
    assert len(got) == len(rows)
    assert result[1] == {(0, 1, 0)} and result[2] == {(0, 2, 0)} and result[4] == {(1, 4, 0)}
    assert result[6] == {(1, 6, 0)} and result[7] == {(1, 7, 1)}
    assert result[None] == {(1, None, 0)}
    assert result[31] == {(96, 30, 1)} and result[32] == {(2, 30, 1)}
    assert ngram_join.jaccard_components(frame(spark, [])).count() == 0


def test_components_of_plain_graphs(spark):
    """A long path in mixed order, a star, loops, repeated edges, and no edges at all."""
    path = random.Random(5).sample(range(100, 160), 60)
    edges = [*zip(path, path[1:]), *((7, i) for i in range(8, 30)), (3, 3), (90, 91), (91, 90), (90, 91)]
    found = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    expected = {i: 100 for i in path} | {i: 7 for i in range(7, 30)} | {90: 90, 91: 90}
    assert len(found) == len(expected) and {r["node"]: r["component"] for r in found} == expected
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_search_in_blocks_is_exact():
    pick = np.random.default_rng(2)
    base = [np.unique(pick.integers(0, 60, pick.integers(1, 40))).astype(np.uint64) for _ in range(60)]
    sizes = np.array([len(s) for s in base])
    order = np.argsort(sizes, kind="stable")
    base, sizes = [base[i] for i in order], sizes[order]
    for percent in (30, 75, 100):
        for side in (np.zeros(60, int), np.arange(60) % 2):
            found = {(q, int(p)) for q, ps in ngram_join.search_block(base, sizes, side, percent) for p in ps}
            assert found == {
                (a, b) for a in range(60) for b in range(a + 1, 60)
                if (side[a] != side[b] or not side.any())
                and 100 * len(np.intersect1d(base[a], base[b])) >= percent * len(np.union1d(base[a], base[b]))
            }


# --- SentencePiece -----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def model():
    tokenizers = pytest.importorskip("public_tokenizers")
    return pieces.read_model(tokenizers.path("piece_bpe_32k.model"))


def test_ids_equal_the_library(spark, model, monkeypatch):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    pick = random.Random(4)
    atoms = [" ", "  ", "a", "the", "\n", "\t", "▁", "é", "😀", "\x00", "<s>", "</s>", "<0x0A>", "ﬁ", "ing", "　", "�"]
    rows = [*ODD, *((100 + i, "".join(pick.choices(atoms, k=pick.randrange(15)))) for i in range(500))]
    got = pieces.encode_and_decode(frame(spark, rows, clash=True), model)
    assert set(got.columns) == {"doc_id", "text", "decoded", *CLASH}
    for r in got.collect():
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert ids == [1, *library.encode(r["text"] or ""), 2]
        assert r["decoded"] == library.decode(ids)
    digests = pieces.encode_and_decode(frame(spark, rows), model, digests=True).collect()
    assert len(digests) == len(rows)
    by_id = {r["doc_id"]: r for r in digests}
    assert by_id[1]["n_tokens"] == 2 and by_id[1]["decoded_sha256"] == hashlib.sha256(b"").hexdigest()
    assert pieces.encode_and_decode(frame(spark, []), model).count() == 0


def test_a_full_table_starts_anew(model):
    table = pieces.PieceTable(model, limit=3)
    for text in ("a b c d e", "f g", "a b"):
        found = pieces.marked_words(text)
        assert set(found) <= set(table.look_up([found]))


# --- license scans -----------------------------------------------------------------------------


def test_planted_notices_are_found(spark):
    names = list(licenses.NOTICES)
    rows = []
    for i in range(120):
        before, after = prose(i, i % 23), prose(-i, (7 * i) % 31)
        notice = words(licenses.NOTICES[names[i % len(names)]])
        rows.append((i, " ".join([*before, *notice, *after]) if i % 5 else " ".join(before + after)))
    got = licenses.scan_licenses(frame(spark, rows, clash=True)).collect()
    expected = {(i, names[i % len(names)], i % 23) for i in range(120) if i % 5}
    assert {(r["doc_id"], r["license"], r["first_word"]) for r in got} == expected
    assert all(r["containment"] == 1.0 for r in got)
    for r in got:
        assert r["last_word"] - r["first_word"] + 1 == len(words(licenses.NOTICES[r["license"]]))


def test_altered_notices_are_judged_by_containment(spark):
    name = "mit-permission"
    whole = words(licenses.NOTICES[name])
    rows = [(i, " ".join(prose(i, 30) + varied(whole, i, i) + prose(i, 30))) for i in range(12)]
    template = shingles(licenses.NOTICES[name])
    expected = {i for i, t in rows if len(shingles(t) & template) >= math.ceil(0.75 * len(template))}
    got = licenses.scan_licenses(frame(spark, rows)).collect()
    assert {r["doc_id"] for r in got if r["license"] == name} == expected
    assert 0 < len(expected) < 12


def folded_shingles(text):
    """Shingles of words without ASCII punctuation."""
    return shingles(re.sub(r"[\x21-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]", " ", text or ""))


def test_no_notice_contains_another():
    sets = {name: folded_shingles(text) for name, text in licenses.NOTICES.items()}
    for a, mine in sets.items():
        for b, other in sets.items():
            assert a == b or len(mine & other) < 0.75 * len(other)


def test_notices_as_people_write_them(spark):
    texts = {
        "We have Released under the MIT License and more": {"mit"},
        "it is licensed under cc by-nc 4.0 and nothing else": {"cc-by-nc-4.0"},
        'Licensed under the Apache License, Version 2.0 (the "License");\n * you may not use this file except in\n'
        " * compliance with the License.\n * You may obtain a copy of the License at\n *\n"
        " *     http://www.apache.org/licenses/LICENSE-2.0\n": {"apache-2.0", "apache-2.0-terms"},
        "# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General"
        " Public License as published by\n# the Free Software Foundation, either version 3 of the License, or\n"
        "# (at your option) any later version.": {"gnu-gpl", "gnu-3.0-or-later"},
        "under the terms of the GNU Lesser General Public License; either version 2.1 of the License, or (at your option)"
        " any later version.": {"gnu-lgpl", "gnu-2.1-or-later"},
        "Released under a MIT License": set(),
    }
    rows = [(i, text) for i, text in enumerate(texts)]
    got = licenses.scan_licenses(frame(spark, rows)).collect()
    assert {text: {r["license"] for r in got if r["doc_id"] == i} for i, text in rows} == texts


def test_word_numbers_count_words_between_white_space(spark):
    row = (1, 'a - b (c) "Released under the MIT License", d')
    got = licenses.scan_licenses(frame(spark, [row, row])).collect()
    assert [(r["license"], r["first_word"], r["last_word"]) for r in got] == [("mit", 4, 8)] * 2


def test_all_templates_against_all_texts(spark):
    """Many templates that share words, against plain containment in the texts."""
    notices = {f"n{k}": " ".join(prose(k, 6 + 3 * (k % 20), 90)) for k in range(300)}
    rows = []
    for i in range(150):
        whole = words(notices[f"n{i * 2}"])
        rows.append((i, " ".join(prose(1000 + i, 40) + varied(whole, i, i % 4) + prose(2000 + i, 25))))
    rows += [(500 + i, t) for i, t in rows[:10]]
    sets = {name: folded_shingles(text) for name, text in notices.items()}
    expected = {
        (i, name) for i, text in rows for name, need in sets.items()
        if len(folded_shingles(text) & need) >= math.ceil(0.75 * len(need) - 1e-9)
    }
    got = licenses.scan_licenses(frame(spark, rows), notices=notices).collect()
    assert {(r["doc_id"], r["license"]) for r in got} == expected and len(expected) > 60


def test_looking_up_does_not_follow_the_number_of_templates():
    text = pa.array([" ".join(prose(i, 400)) for i in range(400)])

    def seconds(count):
        notices = {f"n{k}": " ".join(prose(10_000 + k, 16, 10**6)) for k in range(count)}
        classes = licenses.template_classes(notices, 0.75, 0.9999)
        tables = [c.minima(licenses._salts(c.bands)) for c in classes]
        times = []
        for _ in range(3):
            begin = time.process_time()
            licenses.scan_slice(text, classes, 0.75, tables)
            times.append(time.process_time() - begin)
        return min(times)

    assert seconds(300) < 3 * seconds(3)


def test_licenses_of_odd_rows(spark):
    assert licenses.scan_licenses(frame(spark, ODD)).count() == 0
    assert licenses.scan_licenses(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        licenses.template_classes({"short": "too few words"}, 0.75, 0.99)


# --- packing -----------------------------------------------------------------------------------


def one_by_one(lengths, sizes, least, cost):
    """Best fit decreasing, bin by bin: [(room, size, contents)] after shrinking."""
    bins = []
    for length in sorted(lengths, reverse=True):
        fitting = [b for b in bins if b[0] >= length]
        if fitting:
            best = min(fitting, key=lambda b: b[0])
        else:
            size = min((s for s in sizes if s >= max(length, least)), key=lambda s: (cost(s) / s, s))
            best = [size, size, []]
            bins.append(best)
        best[0] -= length
        best[2].append(length)
    return [(min(s for s in sizes if s >= sum(c)), sorted(c)) for _, _, c in bins]


@pytest.mark.parametrize("seed", range(6))
def test_counts_are_packed_like_single_pieces(seed):
    pick = random.Random(seed)
    sizes = (8, 16, 40)
    lengths = [pick.choice((1, 2, 3, 5, 8, 13, 21, 40)) for _ in range(200)]
    for least in sizes:
        got = packing._pack_counts(dict(collections.Counter(lengths)), sizes, least, packing.bin_cost)
        expected = one_by_one(lengths, sizes, least, packing.bin_cost)
        assert sum(b.count for b in got) == len(expected)
        # equal room may differ in contents, so compare what is left of it
        room = lambda bins: collections.Counter(s - sum(c) for s, c in bins)
        flat = [(b.size, [x for x, n in b.contents for _ in range(n)]) for b in got for _ in range(b.count)]
        assert sorted(x for _, c in flat for x in c) == sorted(lengths)
        assert room(flat) == room(expected)


def test_token_counts_of_a_model_are_packed(spark, model):
    rows = [*ODD[:4], *((100 + i, " ".join(prose(i, (i * 11) % 60))) for i in range(40))]
    encoded = pieces.encode_and_decode(frame(spark, rows), model, digests=True)
    expected = collections.Counter()
    for r in encoded.collect():
        expected[r["doc_id"]] += r["n_tokens"]
    got = packing.pack_documents(encoded, length=F.col("n_tokens"), sizes=(32, 128, 512)).collect()
    tokens, used = collections.Counter(), collections.Counter()
    for r in got:
        tokens[r["doc_id"]] += r["n_tokens"]
        used[r["bin_id"], r["bin_size"]] += r["n_tokens"]
    assert tokens == expected
    assert all(n <= size for (_, size), n in used.items()) and len({b for b, _ in used}) == len(used)


def test_every_token_has_its_own_place(spark):
    rows = [*ODD, *((100 + i, " ".join(prose(i, (i * 37) % 150))) for i in range(300))]
    sizes = (16, 32, 64)
    got = packing.pack_documents(frame(spark, rows, clash=True), sizes=sizes).collect()
    tokens = collections.Counter()
    filled = collections.defaultdict(list)
    for r in got:
        tokens[r["doc_id"]] += r["n_tokens"]
        if r["n_tokens"]:
            assert r["start"] == 64 * r["piece"] and r["bin_size"] in sizes
            filled[r["bin_id"], r["bin_size"]].append((r["bin_offset"], r["n_tokens"]))
        else:
            assert r["bin_id"] is None
    expected = collections.Counter()
    for i, text in rows:
        expected[i] += len(words(text))
    assert tokens == expected
    assert len({b for b, _ in filled}) == len(filled)
    for (_, size), parts in filled.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size and size == min(s for s in sizes if s >= at)
    assert packing.pack_documents(frame(spark, [])).count() == 0


def test_sizes_are_optimised_together():
    counts = {100: 1000, 5: 3000}
    bins = packing.pack_counts(counts, (128, 1024))
    alone = [packing._pack_counts(counts, (128, 1024), s, packing.bin_cost) for s in (128, 1024)]
    cost = lambda bins: sum(b.count * packing.bin_cost(b.size) for b in bins)
    assert cost(bins) == min(map(cost, alone))


# --- language ----------------------------------------------------------------------------------


@data
def test_held_out_languages_are_recognised(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.fit_language_model(docs, sample_per_language=60)
    got = language.identify_language(docs, model).filter(F.crc32(F.col("doc_id").cast("string")) % 4 == 2)
    right = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.97


def test_language_of_odd_rows(spark):
    rows = [(i, "the quick brown fox") for i in range(40)] + [(40 + i, "der schnelle braune") for i in range(40)]
    known = frame(spark, rows).withColumn("lang", F.when(F.col("doc_id") < 40, "en").otherwise("de"))
    model = language.fit_language_model(known)
    got = language.identify_language(frame(spark, [*ODD, (50, "123 !!")], clash=True), model)
    assert set(got.columns) == {"doc_id", "text", *CLASH}
    result = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in got.collect()}
    assert [result[i] for i in (1, 2, 3, 50)] == [("und", 0.0)] * 4
    assert all(lang in ("en", "de", "und") and 0 <= score <= 1 for lang, score in result.values())
    nothing = frame(spark, ODD).withColumn("lang", F.lit(None).cast("string"))
    assert language.fit_language_model(nothing) is None
    assert {r["lang_pred"] for r in language.identify_language(nothing, None).collect()} == {"und"}
    assert language.identify_language(frame(spark, []), model).count() == 0


def gram_set(text):
    """The character n-grams of a text, as strings."""
    text = "".join(c.lower() if c.isalpha() or ord(c) > 127 else " " for c in text)
    return {text[i : i + n] for n in language.LENGTHS for i in range(len(text) - n + 1)}


def test_kernel_equals_that_of_gram_sets(monkeypatch):
    texts = ["abc", "ABC", "xyz", "", "a", "Größe, größer!", "ÅNGSTRÖM größe", "пример ПРИМЕР", "日本語の文", "😀😀 ok 😀"]
    sets = [gram_set(t) for t in texts]
    assert len(set().union(*sets)) > 80
    for at_once in (1 << 20, 4):
        monkeypatch.setattr(language, "CHARACTERS_AT_ONCE", at_once)
        x = np.concatenate(list(language.presence_blocks(pa.array([*texts, None]))))
        assert x.sum(1).tolist() == [len(s) for s in sets] + [0]
        k = language.kernel(x, x)
        for i, one in enumerate(sets):
            for j, other in enumerate(sets):
                size = max(len(one), 1) * max(len(other), 1)
                assert k[i, j] == pytest.approx(len(one & other) / size**0.5, abs=1e-6)


def test_all_landmarks_give_plain_kernel_ridge_regression():
    import random

    pick = random.Random(4)
    vocabulary = {"a": ["der", "die", "das", "und", "nicht"], "b": ["the", "and", "not", "of", "das"], "c": ["le", "et", "non"]}
    langs = ["a"] * 20 + ["b"] * 9 + ["c"] * 5
    texts = [" ".join(pick.choices(vocabulary[l], k=6)) for l in langs]
    x = np.concatenate(list(language.presence_blocks(pa.array(texts))))
    model = language.fit_ridge(x, langs, landmarks=len(langs), ridge=0.05)
    new = next(language.presence_blocks(pa.array(["das und der", "the das of", "et et le non", "zzz"])))
    # (K + ridge * W^-1)^-1 y, each language of weight 1
    k = language.kernel(x, x).astype(float)
    y = np.array([[float(l == n) for n in "abc"] for l in langs])
    plain = language.kernel(new, x) @ np.linalg.solve(k + 0.05 * np.diag([langs.count(l) for l in langs]), y)
    assert model.languages == ("a", "b", "c")
    assert model.scores(new) == pytest.approx(plain, abs=1e-3)


def test_equal_scores_go_to_the_first_language(spark):
    rows = [(i, "one and the same") for i in range(60)]
    known = frame(spark, rows).withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "y").otherwise("x"))
    x = np.ones((2, language.DIMS), bool)
    model = language.LanguageModel(("x", "y"), x[:1], np.ones((1, 2), np.float32))
    got = language.identify_language(known.unionAll(known), model).collect()
    assert len(got) == 120 and {r["lang_pred"] for r in got} == {"x"}


def test_fit_takes_the_first_of_each_language(spark):
    """Bounded per language, also where one id has most rows; rare languages are taken whole."""
    rows = [(i, f"text {chr(97 + i % 26)} {chr(97 + i // 26 % 26)}") for i in range(2000)] + [(7, "text again")] * 900
    lang = F.when(F.col("doc_id") % 100 == 3, "rare").when(F.col("doc_id") % 2 == 0, "even").otherwise("odd")
    model = language.fit_language_model(frame(spark, rows).withColumn("lang", lang), sample_per_language=30)
    assert model.languages == ("even", "odd", "rare") and len(model.landmarks) <= 90


# --- quality classifier ------------------------------------------------------------------------


def sparse(rows):
    """Rows as dictionaries of features, in the form the machine takes."""
    sizes = [len(r) for r in rows]
    return quality_model.SparseRows(
        np.concatenate([[0], np.cumsum(sizes)]),
        np.array([f for r in rows for f in r]), np.array([x for r in rows for x in r.values()]),
    )


def test_interactions_by_sums_of_squares():
    pick = np.random.default_rng(1)
    dims = quality_model.DIMS
    machine = quality_model.FactorisationMachine(0.3, pick.normal(0, 1, dims), pick.normal(0, 1, (dims, 3)))
    rows = [
        {int(i): pick.normal(0, 0.5) for i in pick.choice(dims, n, replace=False)} for n in (6, 1, 40, 6)
    ]
    raw = []
    for row in rows:
        pairs = sum(
            machine.factors[i] @ machine.factors[j] * row[i] * row[j] for i in row for j in row if i < j
        )
        raw.append(machine.bias + sum(machine.weights[i] * x for i, x in row.items()) + pairs)
    assert machine.scores(sparse(rows)) == pytest.approx(1 / (1 + np.exp(-np.array(raw))))
    assert machine.scores(sparse([])).tolist() == []


def test_features_equal_those_of_word_sets():
    texts = ["the cat the hat", "", None, "# $ %", "cat", " ".join(f"w{i}" for i in range(3000))]
    sizes = pa.array([5, None, 0, 10**9, -1, 12])
    found = quality_model.feature_rows(pa.array(texts), [sizes])
    one_word = {t: quality_model.feature_rows(pa.array([t])).features[0] for t in {w for x in texts if x for w in x.split()}}
    more = len(quality_model.EDGES) + 1
    for i, text in enumerate(texts):
        mine = slice(found.bounds[i], found.bounds[i + 1])
        cells = sorted({one_word[w] for w in (text or "").split()})
        assert found.features[mine][:-more].tolist() == cells
        assert found.values[mine].tolist() == pytest.approx([max(len(cells), 1) ** -0.5] * len(cells) + [1] * more)
        at = quality_model.WORD_DIMS
        for feature, edges in zip(found.features[mine][-more:], [*quality_model.EDGES.values(), quality_model.METADATA_EDGES], strict=True):
            assert at <= feature < at + len(edges) + 2
            at += len(edges) + 1
    assert quality_model.feature_rows(pa.array([], pa.string())).bounds.tolist() == [0]


def test_gradients_equal_differences_of_the_loss():
    pick = np.random.default_rng(3)
    x = pick.normal(0, 1, (7, 5)) * (pick.random((7, 5)) < 0.6)
    labels, decay = (pick.random(7) < 0.5).astype(float), 0.1
    b, w, v = np.array([0.2]), pick.normal(0, 1, 5), pick.normal(0, 1, (5, 3))

    def loss():
        raw = b[0] + x @ w
        for i in range(5):
            for j in range(i):
                raw = raw + (v[i] @ v[j]) * x[:, i] * x[:, j]
        return np.mean(np.log1p(np.exp(raw)) - labels * raw) + decay / 2 * ((w**2).sum() + (v**2).sum())

    rows = sparse([{i: value for i, value in enumerate(r) if value or i == 0} for r in x])
    found = quality_model.gradients(b[0], w, v, rows, labels, decay)
    for param, gradient in zip((b, w, v), found, strict=True):
        for at in np.ndindex(param.shape):
            before = param[at]
            param[at] = before + 1e-5
            above = loss()
            param[at] = before - 1e-5
            below = loss()
            param[at] = before
            assert gradient[at] == pytest.approx((above - below) / 2e-5, abs=1e-6)


def test_fit_learns_an_interaction():
    """The label is that two of four features meet, which no linear score can tell."""
    pick = np.random.default_rng(5)
    rows, labels = [], []
    for _ in range(1200):
        on = (int(pick.integers(2)), 2 + int(pick.integers(2)))
        rows.append((np.array(on), np.ones(2)))
        labels.append(float(on in ((0, 2), (1, 3))))
    machine = quality_model.fit_machine(rows, np.array(labels), rank=4, epochs=60, dims=8)
    scores = machine.scores(sparse([dict.fromkeys(r[0].tolist(), 1.0) for r in rows]))
    assert ((scores >= 0.5) == np.array(labels)).all()
    assert not machine.factors[4:].any() and not machine.weights[4:].any()


@data
def test_held_out_quality_is_recognised(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = quality_model.fit_quality_model(docs, labels)
    told = quality_model.score_quality(docs, model).join(labels, "doc_id")
    held = told.filter(F.crc32(F.col("doc_id").cast("string")) % 3 == 1)
    right = held.agg(F.avg((F.col("predicted") == F.col("quality")).cast("double"))).first()[0]
    assert right > 0.95


def test_quality_of_odd_rows(spark):
    labels = spark.createDataFrame([(4, 1, 0), (5, 0, 0), (None, 1, 0), (7, None, 0)], "doc_id long, quality int, toxic int")
    docs = frame(spark, ODD, clash=True)
    got = quality_model.score_quality(docs, quality_model.fit_quality_model(docs, labels))
    assert set(got.columns) == {"doc_id", "text", *CLASH}
    rows = got.collect()
    assert len(rows) == len(ODD)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    empty = quality_model.fit_quality_model(frame(spark, []), labels.limit(0))
    assert quality_model.score_quality(frame(spark, []), empty).count() == 0
    assert quality_model.score_quality(docs, empty).count() == len(ODD)


def test_metadata_is_a_feature_of_quality(spark):
    # the texts say nothing of the label, the size told of them does
    rows = [(i, "the same text", (5 if i % 2 else 50_000) if i % 50 else None) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id long, quality int")
    model = quality_model.fit_quality_model(docs, labels)
    got = quality_model.score_quality(docs, model).filter("n_chars IS NOT NULL").collect()
    assert model.metadata == ("n_chars",) and all(r["predicted"] == r["doc_id"] % 2 for r in got)
    plain = quality_model.fit_quality_model(docs, labels, metadata=())
    assert len({r["score"] for r in quality_model.score_quality(docs, plain).collect()}) == 1
    with pytest.raises(ValueError, match="text"):
        quality_model.fit_quality_model(docs, labels, metadata=["text"])


# --- quality rules -----------------------------------------------------------------------------


def test_binomial_bound_is_exact():
    for n, p in ((1, 0.5), (20, 0.1), (200, 0.02)):
        for k in range(0, n + 1, max(1, n // 7)):
            exact = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
            assert math.exp(quality_rules.log_binomial_cdf(k, n, p)) == pytest.approx(exact, abs=1e-12)


def test_settings_stop_at_the_first_failure():
    assert quality_rules.accepted_setting([0, 0, 5, 90, 0], 1000, 0.02, 0.01) == 2
    assert quality_rules.accepted_setting([0], 10, 0.02, 0.01) is None
    assert quality_rules.accepted_setting([30], 1000, 0.02, 0.01) is None


def test_good_documents_are_rarely_rejected(spark):
    good = [(i, " ".join(prose(i, 40, 10**6))) for i in range(3000)]
    bad = [(3000 + i, " ".join(w + "###" for w in prose(i, 40, 10**6))) for i in range(300)]
    short = [(4000, "too few words"), (4001, " ".join(["a b c d e"] * 9))]
    docs = frame(spark, good + bad + short).withColumn("lang", F.lit("xx"))
    labels = docs.select("doc_id", (F.col("doc_id") < 3000).cast("int").alias("quality"))
    got = quality_rules.apply_quality_rules(docs, labels)
    kept = {r["doc_id"]: r["kept"] for r in got.collect()}
    assert sum(kept[i] for i in range(3000)) >= 0.98 * 3000
    assert not any(kept[3000 + i] for i in range(300)) and not kept[4000] and not kept[4001]
    other = docs.withColumn("lang", F.lit(None).cast("string")).filter("doc_id >= 3000 AND doc_id < 3300")
    judged = quality_rules.apply_quality_rules(docs.unionByName(other), labels.filter("doc_id < 3000"))
    assert judged.filter("lang IS NULL AND kept").count() == 300  # no labels, no rules


def plain_verdicts(rows, labels, risk=0.02, delta=0.05):
    """{id: kept} of (id, stratum, counts) rows, by going through settings and documents one by one."""
    def cells(c):
        words, letters = c["n_words"], c["n_capitals"] + c["n_small"]
        share = lambda a, b: a / b if b else 0.0
        found = {
            "symbols_per_word": share(c["n_symbols"], words), "marks_per_word": share(c["n_marks"], words),
            "capital_share": share(c["n_capitals"], letters), "duplicate_line_share": share(c["n_dup_lines"], c["n_lines"]),
            "repeated_word_share": share(c["n_repeat_words"], words), "word_length": share(c["word_chars"], words),
        }
        size = quality_rules.CELLS
        return {r: min(size, math.ceil(found[r] / top * size)) for r, (_, top) in quality_rules.RULES.items()}

    failed = {i: c["n_words"] < 10 or 100 * c["n_repeat_words"] > 20 * c["n_words"] for i, _, c in rows}
    able = [(i, s, cells(c)) for i, s, c in rows if not failed[i]]
    good = {i for i, *_ in able if labels.get(i) == 1 and zlib.crc32(str(i).encode()) % 4}
    strata = {s for i, s, _ in able if i in good}
    kept = {i: not failed[i] for i, *_ in rows}
    for stratum in strata:
        mine = [(i, c) for i, s, c in able if s == stratum]
        holdout = [c for i, c in mine if i in good]
        chosen = None
        for share in quality_rules.SETTINGS:
            cutoffs = {}
            for rule in quality_rules.RULES:
                others = [c[rule] for i, c in mine if i not in good]
                cutoffs[rule] = next(
                    cell for cell in range(quality_rules.CELLS + 1)
                    if sum(x > cell for x in others) <= share * len(others) and (others or cell == quality_rules.CELLS)
                )
            lost = sum(any(c[r] > cutoffs[r] for r in cutoffs) for c in holdout)
            chance = sum(
                math.exp(math.lgamma(len(holdout) + 1) - math.lgamma(x + 1) - math.lgamma(len(holdout) - x + 1))
                * risk**x * (1 - risk) ** (len(holdout) - x) for x in range(lost + 1)
            )
            if lost > risk * len(holdout) or chance > delta / len(strata):
                break
            chosen = cutoffs
        for i, c in mine if chosen else []:
            kept[i] &= not any(c[r] > chosen[r] for r in chosen)
    return kept


def test_verdicts_equal_the_plain_version(spark):
    pick = random.Random(4)
    rows = []
    for i in range(2400):
        bad = pick.random() < 0.25
        tokens = prose(i, pick.randrange(15, 60), 10**6)
        for _ in range(pick.randrange(0, 20 if bad else 3)):
            tokens[pick.randrange(len(tokens))] += pick.choice(["#", "!!", "%%", "ABC"])
        rows.append((i, " ".join(tokens), pick.choice(["a", "a", None, None, "few"]) if i % 9 else "few", int(not bad)))
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string")
    labels = {i: good for i, _, lang, good in rows if pick.random() < 0.8 and (lang != "few" or i % 10 == 0)}
    told = spark.createDataFrame(list(labels.items()), "doc_id long, quality int")
    stats = text_stats.text_stats(pa.array([r[1] for r in rows]))
    counts = [{k: int(v[n]) for k, v in stats.items()} for n in range(len(rows))]
    expected = plain_verdicts([(r[0], r[2], c) for r, c in zip(rows, counts, strict=True)], labels)
    got = {r["doc_id"]: r["kept"] for r in quality_rules.apply_quality_rules(docs, told, keep=["doc_id"]).collect()}
    assert got == expected
    # the method rejects where there are labels enough, and only there
    by = {s: [i for i, _, lang, _ in rows if lang == s and not got[i]] for s in ("a", None, "few")}
    assert len(by["a"]) > 20 and len(by[None]) > 20 and len(by["few"]) < 5


def test_false_rejections_stay_below_the_risk():
    """Draws of good labels around a true share: more than the risk is seldom accepted."""
    pick = np.random.default_rng(12)
    shares = np.array([0.001, 0.004, 0.01, 0.019, 0.0201, 0.03, 0.06])  # true rejection per setting
    wrong = 0
    for _ in range(2000):
        lost = np.searchsorted(np.sort(pick.random(900)), shares)
        step = quality_rules.accepted_setting(lost, 900, 0.02, 0.05)
        wrong += step is not None and shares[step] > 0.02
    assert wrong / 2000 <= 0.05


def test_rules_on_odd_rows(spark):
    docs = frame(spark, ODD, clash=True).withColumn("lang", F.lit(None).cast("string"))
    labels = spark.createDataFrame([(None, 1), (4, None), (7, 1), (7, 0)], "doc_id long, quality int")
    got = quality_rules.apply_quality_rules(docs, labels)
    assert set(got.columns) == {"doc_id", "text", "lang", *CLASH, *quality_rules.BASE, "base_failed"}
    rows = got.collect()
    assert len(rows) == len(ODD) and all(r["base_failed"] and not r["kept"] for r in rows)
    assert all(r["n_lines"] == -7 for r in rows)
    none = frame(spark, []).withColumn("lang", F.lit("a"))
    assert quality_rules.apply_quality_rules(none, labels).count() == 0

"""Near duplicates against all pairs, with regions small enough to deepen and to be compared in blocks."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from vellum.llm import near_dedup as N
from vellum.llm._shared import components

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def plain_sets(texts, width):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    out = []
    for text in texts:
        words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(fold))
        out.append({tuple(words[i : i + width]) for i in range(len(words) - width + 1)} or ({tuple(words)} if words else set()))
    return out


def plain_components(ids, texts, width):
    sets, up = plain_sets(texts, width), list(range(len(ids)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    least = {}
    for i in range(len(ids)):
        least[find(i)] = min(least.get(find(i), ids[i]), ids[i])
    return {ids[i]: (len(sets[i]), least[find(i)]) for i in range(len(ids))}


def corpus(n_groups=12, copies=6, words=120, edits=4, seed=5):
    pick, texts = random.Random(seed), []
    for _ in range(n_groups):
        base = [f"w{pick.randint(0, 5000)}" for _ in range(words)]
        for c in range(copies):
            own = list(base)
            for _ in range(pick.randint(0, edits) if c else 0):
                own[pick.randrange(words)] = f"x{pick.randint(0, 10**6)}"
            texts.append(" ".join(own).upper() if c == 1 else "  ".join(own))
    texts += [None, "", " \n\t ", "One two", "one TWO", "one two three four", "é   É", "word " * 5000, "word " * 4000]
    pick.shuffle(texts)
    return texts


@pytest.mark.parametrize("width", [4, 5])
def test_equals_all_pairs(spark, width):
    texts = corpus()
    ids = [7 * i + 3 for i in range(len(texts))]
    docs = spark.createDataFrame([(i, t, None, "s", 0) for i, t in zip(ids, texts)], SCHEMA)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.near_duplicates(docs, width).collect()}
    assert got == plain_components(ids, texts, width)


def test_small_regions_go_deeper_and_blocks_join(spark):
    texts = corpus(n_groups=2, copies=40, words=300, edits=3)
    docs = spark.createDataFrame([(i, t, None, "s", 0) for i, t in enumerate(texts)], SCHEMA)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.near_duplicates(docs, 4, region=8).collect()}
    assert got == plain_components(list(range(len(texts))), texts, 4)


def test_a_sparse_pair_of_a_region_in_blocks_is_a_candidate(spark):
    random = np.random.default_rng(2)
    bins = random.integers(1, 256, (60, N.BINS)).astype(np.uint8)
    bins[1] = bins[0]
    bins[1, ::8] = 255 - bins[0, ::8] // 2
    bins[0, 0], bins[1, 0] = 1, 255  # the pair stands at both ends of the first order
    rows = [(i, 1000, [7], bytes(b)) for i, b in enumerate(bins)]
    for region in (4, 8, 4096):
        edges = N.candidate_edges(spark.createDataFrame(rows, "cid bigint, n_shingles bigint, keys array<bigint>, bins binary"), 0.8, region).collect()
        assert {frozenset((r.a, r.b)) for r in edges} == {frozenset((0, 1))}


def planted(n, overlap, words=400, seed=4):
    """Texts that all share ``overlap`` of their words with one template, and nothing else with each other."""
    pick, out = random.Random(seed), []
    base = [f"t{i}" for i in range(words)]
    cut = int(words * overlap)
    for i in range(n):
        out.append(" ".join(base[:cut] + [f"u{i}_{k}" for k in range(words - cut)]))
    pick.shuffle(out)
    return out


def test_texts_that_share_a_template_stay_apart():
    """Pairwise similarity 0.55: no sketch of 300 such texts makes a candidate of any pair."""
    texts = planted(300, 0.71)
    sets = [own for _, data in N.blocks(texts) for buf, a, z, first in [N.word_spans(data)] for own in N.shingle_hashes(N.span_hashes(buf, a, z), first, 4)]
    both = len(np.intersect1d(sets[0], sets[1]))
    assert 0.5 < both / (2 * len(sets[0]) - both) < 0.6
    bins, sizes = np.stack([N.sketch(s) for s in sets]), np.array([len(s) for s in sets])
    label = N.region_labels(bins, sizes, np.zeros(300), False, 0.8)
    assert len(set(label)) == 300


def test_recall_of_planted_pairs(spark):
    """200 pairs of similarity 0.82 to 0.84, far from each other: all are linked, whatever the size of a block."""
    pick, texts = random.Random(6), []
    for g in range(200):
        base = [f"g{g}_{pick.randrange(10**6)}" for _ in range(300)]
        other = list(base)
        for spot in range(20, 300, 42):
            other[spot] = f"new{spot}"
        texts += [" ".join(base), " ".join(other)]
    docs = spark.createDataFrame([(i, t, None, "s", 0) for i, t in enumerate(texts)], SCHEMA)
    want = plain_components(list(range(2)), texts[:2], 4)
    assert want[1][1] == 0
    for region in (4096, 16):
        got = {r.doc_id: r.component_id for r in N.near_duplicates(docs, 4, region=region).collect()}
        assert got == {i: i - i % 2 for i in range(400)}


def test_blocks_by_bytes(spark):
    texts = corpus(n_groups=1, copies=20, words=300, edits=3)
    docs = spark.createDataFrame([(i, t, None, "s", 0) for i, t in enumerate(texts)], SCHEMA)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.near_duplicates(docs, 4, set_bytes=10_000).collect()}
    assert got == plain_components(list(range(len(texts))), texts, 4)


def test_repeated_rows_nulls_and_clashing_columns(spark):
    long = "a b c d e f g h " * 30
    rows = [(1, long, b"1", 2), (1, long, b"1", 2), (2, long, None, None), (None, long, None, 1), (None, None, None, 1), (3, "z", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, fp binary, root int")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in N.near_duplicates(docs, 4).collect()), key=str)
    assert got == sorted([(1, 1, True), (1, 1, True), (2, 1, False), (None, 1, False), (None, None, True), (3, 3, True)], key=str)
    other = docs.withColumnsRenamed({"fp": "_id", "root": "_th"}).withColumn("_once", docs.doc_id).withColumn("_turn", docs.doc_id)
    assert N.one_of_each(other, 4).columns == other.columns and N.one_of_each(other, 4).count() == 3
    kept = N.one_of_each(docs, 4)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "None"]
    bare = spark.createDataFrame([(None, long, b"1", 2), (None, long, b"2", 3), (None, "other words", None, None), (None, "", None, 4), (None, "", None, 5), (8, "", None, 6), (8, "", None, 6)], docs.schema)
    assert sorted((r.text or "")[:5] for r in N.one_of_each(bare, 4).collect()) == ["", "", "", "a b c", "other"]


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert N.near_duplicates(docs).count() == 0
    assert N.one_of_each(docs).count() == 0


def test_exact_links_cross_and_percent():
    sets = [np.array(x, np.uint64) for x in ([1, 2, 3, 4, 5], [1, 2, 3, 4], [1, 2, 3, 9], [50])]
    assert N.exact_links(sets, np.zeros(4), False, 80).tolist() == [0, 0, 2, 3]
    assert N.exact_links(sets, np.array([0, 0, 1, 1]), True, 60).tolist() == [0, 1, 1, 3]
    assert N.exact_links([], np.array([]), False, 80).tolist() == []


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(40)]
    star = [(100, 100 + i) for i in range(1, 30)] + [(100, 100), (101, 100)]
    got = {r.node: r.root for r in components(spark.createDataFrame(path + star, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0

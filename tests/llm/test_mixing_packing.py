"""Mixing against a plain queue, and packing against the constraints and the reference tokenizer."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from vellum.llm import mixing as M
from vellum.llm import packing as K

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def plain_mix(rows, weights=(3, 1, 2), share=1.5):
    """rows: (doc_id, text, source). Targets by handing out the excess again and again; then a queue by finish time."""
    size = [len(re.findall("[^\x20\x09-\x0d]+", t or "")) for _, t, _ in rows]
    names = sorted({s for _, _, s in rows}, key=lambda s: (s is None, (s or "").encode()))
    total = {s: sum(n for n, r in zip(size, rows) if r[2] == s) for s in names}
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    budget, full, target = share * sum(size), set(), {}
    while True:
        rest = budget - sum(2 * total[s] for s in full)
        free = [s for s in names if s not in full]
        target = {s: 2.0 * total[s] for s in full} | {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        above = {s for s in free if target[s] >= 2 * total[s]}
        if not above:
            break
        full |= above
    order = sorted(range(len(rows)), key=lambda i: (hashlib.md5(str(rows[i][0]).encode()).hexdigest(), rows[i][0], size[i]))
    copies, run = [], dict.fromkeys(names, 0)
    for i in order:
        run[rows[i][2]] += size[i]
        for c in (0, 1):
            if size[i] and target[rows[i][2]]:
                copies.append(((c * total[rows[i][2]] + run[rows[i][2]]) / target[rows[i][2]], names.index(rows[i][2]), c, order.index(i), i))
    taken, used = [0] * len(rows), 0
    for *_, i in sorted(copies):
        used += size[i]
        if used > budget:
            break
        taken[i] += size[i]
    return [(r[0], n, total[r[2]], target[r[2]], t) for r, n, t in zip(rows, size, taken)]


def test_mix_equals_a_plain_queue(spark, monkeypatch):
    monkeypatch.setattr(M, "SLICE", 7)
    pick = random.Random(4)
    rows = [(i, "w " * pick.randint(0, 40), pick.choice(["a", "a", "a", "b", "c", None, "Z"])) for i in range(200)] + [(900, None, "b"), (901, "", "only")]
    docs = spark.createDataFrame([(i, t, None, s, 0) for i, t, s in rows], DOCS)
    got = sorted((r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in M.fair_mix(docs).collect())
    assert got == sorted((a, b, c, round(d, 6), e) for a, b, c, d, e in plain_mix(rows))
    by_source = {}
    for r in M.fair_mix(docs).collect():
        by_source.setdefault((r.source, r.target), 0)
        by_source[r.source, r.target] += r.taken
        assert r.taken in (0, r.size, 2 * r.size)
    assert all(abs(t - target) <= 80 for (_, target), t in by_source.items())


def test_many_copies_that_finish_together(spark, monkeypatch):
    monkeypatch.setattr(M, "SLICE", 2)
    rows = [(i, "w " * (1 + i % 3), f"source{i % 150}") for i in range(300)]
    docs = spark.createDataFrame([(i, t, None, s, 0) for i, t, s in rows], DOCS)
    got = sorted((r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in M.fair_mix(docs).collect())
    assert got == sorted((a, b, c, round(d, 6), e) for a, b, c, d, e in plain_mix(rows))


def test_copies_of_rows_that_repeat(spark):
    rows = [(1, "a b c", None, "s", 3)] * 5 + [(2, "x y", None, "s", 4), (2, "x y", None, "t", 4), (None, "n n", None, None, 1), (None, "n n", None, None, 1), (4, None, None, "s", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    want, got = {}, {}
    for i, n, _, _, taken in plain_mix([(r[0], r[1], r[3]) for r in rows if r[0]] + [(-1, "n n", None)] * 2):
        want[i] = want.get(i, 0) + (taken // n if n else 0)
    for r in M.mixed_documents(docs).collect():
        got[r.doc_id or -1] = got.get(r.doc_id or -1, 0) + 1
    assert sum(got.values()) == sum(want.values()) and got[2] <= 4 and got.get(4, 0) == 0 and got[-1] <= 4


def test_mix_edges(spark):
    empty = spark.createDataFrame([], DOCS)
    assert M.fair_mix(empty).count() == 0 and M.mixed_documents(empty).count() == 0
    nothing = spark.createDataFrame([(1, None, None, None, None), (2, "  ", None, "s", 1)], DOCS)
    assert [(r.size, r.taken) for r in M.fair_mix(nothing).collect()] == [(0, 0)] * 2
    rows = [(1, "a b", "s", 1, "x"), (1, "a b", "s", 1, "x"), (None, "c " * 50_000, None, 2, None), (3, "d e f", "t", 3, "y")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, size int, whole string")
    mixed = M.mixed_documents(docs)
    assert mixed.columns == docs.columns
    want = {}
    for r in M.fair_mix(docs).collect():
        want[r.doc_id] = want.get(r.doc_id, 0) + r.copies
    got = {}
    for r in mixed.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == {k: v for k, v in want.items() if v}


def test_main_path_is_native(spark):
    docs = spark.createDataFrame([(1, "a b", None, "s", 1)], DOCS)
    for df in (M.fair_mix(docs), M.mixed_documents(docs)):
        assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())


def reference_ids(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    own.encode_special_tokens = True
    return own.encode(text or "", add_special_tokens=False).ids + [0]


TEXTS = [None, "", " ", "Hello  world", "é" * 50, "a" * 20_000, "many words here " * 2500, "\x00 odd ​ text\n\n\n", "emoji 😀 " * 40] + [f"line {i} " * (i * 7) for i in range(1, 60)]


def test_packing_is_lossless_and_tight(spark):
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(TEXTS)], DOCS)
    rows = K.packed(docs).collect()
    by_doc, bins = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        bins.setdefault(r.sequence_id, []).append(r)
    total = 0
    for i, text in enumerate(TEXTS):
        ids = reference_ids(text)
        total += len(ids)
        at = 0
        for k, r in enumerate(sorted(by_doc[i], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (k, at)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            assert r.length == 2048 or k == 0
            at += r.length
        assert at == len(ids) and (len(by_doc[i]) == 1 or len(ids) > 2048)
    for own in bins.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    assert len(bins) <= -(-total // 2048) + 1


def test_packing_has_the_ids_of_the_tokenizer_as_it_is(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [*TEXTS, "a <|endoftext|> b", "<|endoftext|>", "x  <|endoftext|><|endoftext|>\n\n y", "<|endoftext|", "word <|endoftext|> " * 1500]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS)
    want = []
    for i, text in enumerate(texts):
        ids = own.encode(text or "", add_special_tokens=False).ids + [0]
        want += [(i, k, s, n, zlib.crc32(np.array(ids[s : s + n], "<u4").tobytes())) for k, (s, n) in enumerate(K.cut_points(len(ids), 2048))]
    assert sorted(tuple(r)[:5] for r in K.packed(docs).collect()) == want


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_every_capacity_binds(rule):
    lengths = np.random.default_rng(1).integers(1, 400, 500)
    where, offset = K.pack(lengths, 1000, 6, 250_000, rule)
    for b in np.unique(where):
        own = where == b
        assert lengths[own].sum() <= 1000 and own.sum() <= 6 and (lengths[own].astype(float) ** 2).sum() <= 250_000
        spans = sorted(zip(offset[own], lengths[own]))
        assert all(a + n == c for (a, n), (c, _) in zip(spans, spans[1:])) and spans[0][0] == 0
    with pytest.raises(ValueError):
        K.pack(np.array([900]), 1000, 6, 250_000, rule)


def test_best_fit_beats_next_fit():
    lengths = np.random.default_rng(2).integers(1, 2049, 3000)
    where, _ = K.pack(lengths, 2048, 2048, 2048**2)
    assert len(np.unique(where)) <= 1.02 * lengths.sum() / 2048 + 1


def test_packing_edges(spark):
    assert K.packed(spark.createDataFrame([], DOCS)).count() == 0
    docs = spark.createDataFrame([(1, "x", 5), (1, "x", 5), (None, "y", None)], "doc_id bigint, text string, grp int")
    rows = K.packed(docs).collect()
    assert len(rows) == 3 and len({(r.sequence_id, r.offset) for r in rows}) == 3
    tight = K.packed(docs, max_docs=1).collect()
    assert len({r.sequence_id for r in tight}) == 3
    assert K.cut_points(4096, 2048) == [(0, 2048), (2048, 2048)] and K.cut_points(2049, 2048) == [(0, 1), (1, 2048)] and K.cut_points(5, 2048) == [(0, 5)]

"""Exact dedup, lexical search and whitening against plain versions, and their odd cases."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from vellum.llm import exact_dedup, lexical, queries, whitening

# ---- exact dedup


def plain_dedup(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups["".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")].append(i)
    out = []
    for text, ids in groups.items():
        top, given = max((i for i in ids if i is not None), default=None), False
        for i in ids:
            kept = i == top and not given
            given = given or kept
            out.append((i, top, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


ROWS = [(i, t) for i, t in enumerate(["Aa", "aA", "É", "é", None, "", " ", "x" * 100_000, "X" * 100_000, "İ", "i̇"] + [f"t{i % 50}" for i in range(300)] + ["hot"] * 200)]
ROWS += [(None, "t1"), (None, None), (7, "x" * 100_000), (8, "X" * 100_000), (None, "n"), (None, "N"), (12, "t1"), (12, "t1")]


@pytest.mark.parametrize("limits", [{}, {"bits": 3}, {"bucket": 200, "owner": 100_000, "run": 10}, {"bits": 6, "bucket": 16, "owner": 100_000, "run": 1_000}])
def test_exact_dedup_equals_a_plain_version(spark, limits):
    """Also with keys of few bits, whose chains are long, and with buckets that are split many times."""
    docs = spark.createDataFrame([(i, t, "k", 1) for i, t in ROWS], "doc_id bigint, text string, key string, n int").repartition(5)
    got = sorted((tuple(r) for r in exact_dedup.exact_dedup(docs, **limits).collect()), key=str)
    assert got == plain_dedup(ROWS)


def test_exact_dedup_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert exact_dedup.exact_dedup(docs).columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"] and exact_dedup.exact_dedup(docs).count() == 0


def test_buckets_of_the_directory(spark):
    """Every slot has one bucket of its own prefix; only buckets of one key, or of texts that cannot be split, hold more than the limit."""
    random = np.random.default_rng(1)
    keys = [int(k) for k in random.integers(-(2**63), 2**63 - 1, 400)] + [2**62 + i for i in range(3)]
    table = spark.createDataFrame([(k, 10) for k in keys], "key bigint, n_bytes int")
    directory, depth = exact_dedup.grow_directory(table, bucket=80)
    slots = {r.slot: (r.bucket, r.depth) for r in directory.collect()}
    held = Counter()
    for k in keys:
        slot = (k % 2**64) >> (64 - depth)
        bucket, own = slots[slot]
        assert slot >> (depth - own) == bucket >> (depth - own) and bucket % 2 ** (depth - own) == 0
        held[bucket] += 10
    assert max(held.values()) <= 80 and len(held) > 400 * 10 / 80
    assert len({d for _, d in slots.values()}) > 1  # some were split further than others


def test_owner_chains_compare_bytes(spark):
    """Texts of one key make links by their bytes alone; equal texts that come apart share a link, an equal digest of other bytes is an error."""
    import pyarrow as pa

    def chain(rows):
        names = ["bucket", "key", "digest", "text"]
        batches = [pa.RecordBatch.from_arrays([pa.array([r[i] for r in part], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.binary(), pa.binary()))], names) for part in (rows[:2], rows[2:])]
        return [(r["key"], r["link"], r["text"]) for b in exact_dedup._owner(iter(batches)) for r in b.to_pylist()]

    assert chain([(0, 5, b"1", b"a"), (0, 5, b"2", b"b"), (0, 5, b"1", b"a"), (0, 6, b"1", b"a")]) == [(5, 0, b"a"), (5, 1, b"b"), (6, 0, b"a")]
    with pytest.raises(ValueError, match="digest"):
        chain([(0, 5, b"1", b"a"), (0, 5, b"1", b"b")])


# ---- lexical search

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_search(docs, items, k):
    cut = lambda t: WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    texts = [(i, cut(t)) for i, t in docs]
    texts = [(i, ws, Counter(ws)) for i, ws in texts if ws]
    n_docs, n_terms = len(texts), sum(len(ws) for _, ws, _ in texts)
    df = Counter(t for _, _, c in texts for t in c)
    out = []
    for item, text in set(items):
        scored = []
        for i, ws, c in texts:
            m = 75 + 25 * len(ws) * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m)) for t in cut(text) if c[t])
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, rank, None if null else i, -s) for rank, (s, null, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def words_of(random, n):
    return " ".join(f"w{int(x)}" for x in random.zipf(1.3, n) if x < 3_000)


@pytest.mark.parametrize("limits", [{}, {"window": 7, "segment": 500}, {"block": 100, "sample": 30, "window": 16}])
def test_ranked_search_equals_a_plain_version(spark, limits):
    random = np.random.default_rng(5)
    docs = [(i, words_of(random, int(random.integers(1, 120)))) for i in range(400)]
    docs += [(400 + i, docs[i % 5][1]) for i in range(30)]  # ties
    docs += [(3, docs[3][1]), (None, docs[2][1]), (None, "W1 É"), (500, None), (501, ""), (502, "!?"), (503, "w1 " * 20_000), (504, "É é\x85ß"), (-9, docs[0][1])]
    items = [(i, words_of(random, int(random.integers(1, 40)))) for i in range(25)]
    items += [(1, items[1][1]), (2, "w1 w1 w2"), (None, "w5"), (90, None), (91, ""), (92, "nowhere"), (93, "É"), (94, "é ß W7"), (95, "w1")]
    a = spark.createDataFrame([(i, t, 0, "x") for i, t in docs], "doc_id bigint, text string, id int, terms string").repartition(4)
    b = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id bigint, text string, item int")
    got = sorted((tuple(r) for r in lexical.ranked_search(a, b, k=20, **limits).collect()), key=str)
    assert got == plain_search(docs, [x for x in items if x[1] is not None], 20)


def test_ranked_search_of_nothing(spark):
    docs, items = spark.createDataFrame([], "doc_id bigint, text string"), spark.createDataFrame([], "item_id bigint, text string")
    one = spark.createDataFrame([(1, "a b")], docs.schema)
    asked = spark.createDataFrame([(1, "a b")], items.schema)
    for a, b in ((docs, items), (docs, asked), (one, items)):
        assert lexical.ranked_search(a, b).count() == 0
    assert [tuple(r)[:3] for r in lexical.ranked_search(one, asked).collect()] == [(1, 1, 1)]


def test_windows_are_skipped(spark):
    """Bounds leave most windows of a common word's list unread, and the results stay."""
    n = 4_000
    tf = np.ones(n, np.int64)
    tf[::1_000] = 50
    seen = []
    part = lexical.Segment(np.arange(n), np.full(n, 50), np.ones(n, np.int64), np.zeros(n, np.int64), tf, (10 * n, 500 * n, {0: 2_000}), window=50)
    whole = part.window
    part.window = lambda *a: seen.append(a[0]) or whole(*a)
    scores, ids = part.search([(0, 1)], 4, (np.empty(0, np.int64), np.empty(0, np.int64)), 1)
    assert ids.tolist() == [0, 1_000, 2_000, 3_000] and len(set(scores.tolist())) == 1
    assert len(seen) == 4


# ---- whitening


def plain_whitening(rows, k):
    rows = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max((len(v) for _, v in rows), default=0)
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] + [1_000_000] * (width - len(v)) for _, v in rows]
    fit = sorted(set(map(tuple, x)))
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    away = np.array([[n * a - s for a, s in zip(r, sums, strict=True)] for r in fit], float) / n
    values, basis = np.linalg.eigh(away.T @ away / n)
    values, basis = values[::-1], basis[:, ::-1]
    out = []
    for (i, _), r in zip(rows, x, strict=True):
        d = [n * a - s for a, s in zip(r, sums, strict=True)]
        out.append((i, n, sum(a * a for a in d), (np.array(d) / n) @ basis[:, :k] / np.sqrt(np.maximum(values[:k], 1e-300))))
    return out, values[:k] / values.sum(), values


def check_whitening(got, rows, k):
    want, shares, values = plain_whitening(rows, k)
    k = min(k, int((values > 1e-9 * values[0]).sum()))
    table = defaultdict(dict)
    for r in got:
        table[r.vec_id, r.component].setdefault("z", []).append(r.whitened)
        assert abs(r.explained - shares[r.component - 1]) < 1e-10 and r.identity_error < 1e-9
    assert len(got) == len(want) * k
    assert sorted(((r.vec_id, r.n, r.deviation) for r in got if r.component == 1), key=str) == sorted(((i, n, d) for i, n, d, _ in want), key=str)
    for c in range(1, k + 1):
        mine, own = defaultdict(list), defaultdict(list)
        for (i, comp), v in table.items():
            if comp == c:
                mine[i] = sorted(v["z"])
        for i, _, _, z in want:
            own[i].append(z[c - 1])
        same = max(abs(a - b) for i in own for a, b in zip(mine[i], sorted(own[i]), strict=True))
        turned = max(abs(a - b) for i in own for a, b in zip(mine[i], sorted(-x for x in own[i]), strict=True))
        assert min(same, turned) < 1e-9


def test_whitening_equals_a_plain_version(spark):
    random = np.random.default_rng(2)
    spread = random.normal(0, 1, (20, 20)) * np.linspace(1, 3, 20)
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(random.normal(0, 0.5, (700, 20)) @ spread)]
    rows += [(1_000 + i, rows[0][1]) for i in range(300)]  # one hot vector
    rows += [(None, rows[5][1]), (5, rows[6][1]), (2_000, None), (2_001, [None] * 20), (2_002, [float("nan")] * 20), (2_003, [float("-inf")] * 20), (2_004, [0.25] * 7), (2_005, [])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id bigint, embedding array<float>, id int, x string")
    for parts in (1, 3, 20):
        check_whitening(whitening.whitened(df.repartition(parts)).collect(), rows, 16)


def test_whitening_of_few_dimensions_and_low_rank(spark):
    random = np.random.default_rng(4)
    low = random.integers(-3, 4, (200, 2)) @ np.array([[1.0, 0, 2, 0, 0], [0, 1, 1, 0, 0]])
    for vectors in (random.normal(0, 5, (50, 1)), random.normal(0, 5, (60, 3)), low):
        rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(vectors)]
        check_whitening(whitening.whitened(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")).collect(), rows, 16)
    schema = "vec_id bigint, embedding array<float>"
    for rows in ([], [(1, None)], [(1, [])], [(1, [0.5, 2.0]), (2, [0.5, 2.0])]):
        assert whitening.whitened(spark.createDataFrame(rows, schema)).count() == 0


@pytest.mark.parametrize("kind", ["normal", "integers", "repeated", "flat", "close"])
def test_rank_one_updates(kind):
    """The spectrum of vectors taken one by one, and of two lists combined, is that of their scatter."""
    random = np.random.default_rng(3)
    for d in (1, 2, 7, 33):
        x = random.normal(0, 10, (150, d))
        x = {"normal": x, "integers": np.round(x), "repeated": np.repeat(x[:3], 50, 0), "flat": x * (np.arange(d) < (d + 1) // 2), "close": x[:1] + np.round(x * 1e-3, 3)}[kind]
        one, two = whitening.Spectrum(d), whitening.Spectrum(d)
        for v in x[:90]:
            one.add(v)
        for v in x[90:]:
            two.add(v)
        one.combine(two)
        centred = x - x.mean(0)
        scatter = centred.T @ centred
        size = max(np.abs(scatter).max(), 1e-6 if kind == "close" else 1e-300)
        assert np.abs(one.vectors @ np.diag(one.values) @ one.vectors.T - scatter).max() < 1e-10 * size + 1e-9 * (kind == "repeated")
        assert np.abs(one.vectors.T @ one.vectors - np.eye(d)).max() < 1e-11


def test_deviations_past_64_bits():
    x = np.array([[3, -4]], np.int64)
    assert whitening.deviations(x, 10**18, [5, 7]).tolist() == [[3 * 10**18 - 5, -4 * 10**18 - 7]]


@pytest.mark.parametrize("name", ["op11_exact_dedup", "op12_lexical"])
def test_queries_equal_their_sql(spark, sf_dir, name):
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    want = con.execute(queries.ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(map(tuple, queries.QUERIES[name](spark, sf_dir).select(*columns).collect())) == sorted(want.fetchall())


def test_whitening_query(spark, sf_dir):
    got = queries.QUERIES["op13_whitening"](spark, sf_dir).collect()
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    check_whitening(got, rows, 16)

"""Language identification and toxicity: held-out accuracy, exactness of the forward sums, and odd rows."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from vellum.llm import language as G
from vellum.llm import queries as Q
from vellum.llm import toxicity as T

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def plain_word(word, table, names, column):
    marked, total = "▁" + word, [1.0] + [0.0] * (len(word) + 1)
    number = {p: i for i, p in enumerate(names)}
    for b in range(1, len(marked) + 1):
        for a in range(max(0, b - G.PIECE), b):
            piece = marked[a:b]
            p = table[number[piece], column] if piece in number else 0.0
            total[b] += total[a] * (max(p, G.FLOOR) if b - a == 1 else p)
    return math.log(total[len(marked)])


def test_forward_sums_equal_all_segmentations():
    names = G.vocabulary()
    pieces = G.Pieces(names)
    random_table = np.random.default_rng(1).random((pieces.n + 1, 2)) * 1e-3
    random_table[pieces.n] = 0
    words = ["the", "weather", "a", "straße", "日本", "zzzzqqqq", "x" * 31]
    got = G.word_scores(words, pieces, random_table)
    for i, w in enumerate(words):
        for c in range(2):
            assert got[i, c] == pytest.approx(plain_word(w, random_table, names, c))


def plain_log_word(word, table, number):
    """Log-probabilities with logarithms throughout, so that no length is too long."""
    marked, out = "▁" + word, []
    for c in range(table.shape[1]):
        total = [0.0]
        for b in range(1, len(marked) + 1):
            terms = []
            for a in range(max(0, b - G.PIECE), b):
                p = table[number[marked[a:b]], c] if marked[a:b] in number else 0.0
                p = max(p, G.FLOOR) if b - a == 1 else p
                if p:
                    terms.append(total[a] + math.log(p))
            total.append(float(np.logaddexp.reduce(terms)))
        out.append(total[-1])
    return out


def test_long_words_are_summed_whole(monkeypatch):
    """Words of any length, in one block and over several, with parts that the floor alone carries."""
    monkeypatch.setattr(G, "STRETCH", 50)
    names = G.vocabulary()
    number, pieces = {p: i for i, p in enumerate(names)}, G.Pieces(names)
    table = np.random.default_rng(2).random((pieces.n + 1, 3)) * 1e-3
    table[pieces.n] = 0
    unit = "weatherstationmaßnahmen日本語のテキスト"
    words = [(unit * 50)[:n] for n in (1, 31, 32, 33, 63, 64, 255, 256, 257, 300, 306, 307, 1000)] + ["ﬓ" * 200, "ﬓ" * 700, "the"]
    for cells in (G.CELLS, 300):
        monkeypatch.setattr(G, "CELLS", cells)
        got = G.word_scores(words, pieces, table)
        for i, w in enumerate(words):
            assert got[i] == pytest.approx(plain_log_word(w, table, number), rel=1e-9)


def test_long_words_count_by_their_letters():
    assert G.evidence(["a", "b" * 31, "c" * 32, "d" * 63]) == 1 + 1 + 2 + 3 and G.evidence([]) == 0
    assert G.parts_of(["a", "b" * 70]) == ["a", "b" * 31, "b" * 31, "b" * 8]


def test_pieces_are_found_by_hash():
    names = G.vocabulary()
    pieces = G.Pieces(names)
    hashes = np.array([pieces._of(n) for n in names] + [pieces._of("no such piece")], np.uint64)
    assert (pieces.find(hashes) == np.arange(len(names) + 1)).all()


def test_learning_tells_languages_apart():
    counts = {"en": Counter("the cat and the other weather".split()), "de": Counter("der und die andere straße wetter".split())}
    names = G.vocabulary()
    pieces = G.Pieces(names)
    languages, table = G.learn(counts, pieces)
    assert languages == ["de", "en"] and table.sum(0) == pytest.approx([1, 1])
    assert G.word_scores(["the"], pieces, table).argmax() == 1 and G.word_scores(["und"], pieces, table).argmax() == 0


def test_held_out_languages(spark):
    rows = Q.op6_language(spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    for r in rows.limit(50).collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    got = rows.join(truth, "doc_id").filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert got > 0.97


def small(spark, rows):
    return spark.createDataFrame([(i, t, g, "s", 0) for i, (t, g) in enumerate(rows)], DOCS)


def test_language_of_odd_rows(spark):
    rows = [("the cat and the dog", "en"), ("der hund und die katze", "de")] * 5 + [(None, "en"), ("", "en"), ("12 34 !!", None), ("the " * 200_000, None), ("x" * 5000, None), ("the und", None)]
    docs = small(spark, rows).withColumn("score", F.lit("clash")).withColumn("id", F.lit(1)).withColumn("n", F.lit(2))
    model = G.train(docs, F.col("doc_id") >= 0)
    got = {r.doc_id: (r.lang_pred, r.score) for r in G.identify(docs, model).collect()}
    assert got[0][0] == "en" and got[1][0] == "de" and got[13][0] == "en"
    assert [got[i] for i in (10, 11, 12)] == [("und", 0.0)] * 3
    assert all(0 <= s <= 1 for _, s in got.values()) and len(got) == len(rows)
    kept = G.told(docs, model)
    assert kept.columns == docs.columns and {10, 11, 12}.isdisjoint({r.doc_id for r in kept.collect()})


def test_language_without_labels_or_rows(spark):
    docs = small(spark, [("some text", None), (None, None)])
    model = G.train(docs, F.lit(True))
    assert {r.lang_pred for r in G.identify(docs, model).collect()} == {"und"}
    empty = spark.createDataFrame([], DOCS)
    assert G.identify(empty, G.train(empty, F.lit(True))).count() == 0 and G.told(empty, model).count() == 0


def toxic_corpus(n=400, seed=3):
    pick = random.Random(seed)
    clean = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(n):
        words = [pick.choice(clean) for _ in range(pick.randint(5, 200))]
        bad = i % 4 == 0
        for _ in range(3 if bad else 0):
            words.insert(pick.randrange(len(words)), pick.choice(["Moron!", "idiot", "scumbag" + pick.choice(["s", "gy", "ism"])]))
        rows.append((" ".join(words), int(bad)))
    return rows


def test_toxicity_on_held_out_rows(spark):
    rows = toxic_corpus()
    docs = small(spark, [(t, "en") for t, _ in rows])
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)], "doc_id bigint, toxic int")
    model = T.train(docs, labels, F.col("doc_id") < 320)
    got = {r.doc_id: r.score for r in T.score(docs, model).collect()}
    right = [(got[i] >= 0.5) == bool(y) for i, (_, y) in enumerate(rows) if i >= 320]
    assert sum(right) / len(right) >= 0.97
    assert T.score(docs, model).filter("score < 0 or score > 1").count() == 0
    again = T.train(docs, labels, F.col("doc_id") < 320)
    assert {r.doc_id: r.score for r in T.score(docs, again).collect()} == got


def test_toxicity_of_odd_rows(spark):
    rows = toxic_corpus(120)
    texts = [t for t, _ in rows] + [None, "", " ", "clean " * 200_000, "clean " * 100_000 + "moron idiot"]
    docs = spark.createDataFrame([(i, t, 0.5) for i, t in enumerate(texts)], "doc_id bigint, text string, score double")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)] + [(0, None), (None, 1), (121, 0), (9999, 1)], "doc_id bigint, toxic int")
    model = T.train(docs, labels, F.lit(True))
    got = {r.doc_id: r.score for r in T.score(docs, model).collect()}
    assert got[120] == got[121] == got[122] and got[124] > got[123]
    kept = T.clean(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, s in got.items() if s < 0.5}


def test_toxicity_without_labels(spark):
    docs = small(spark, [("a b", "en"), (None, None)])
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert [r.score for r in T.score(docs, T.train(docs, none, F.lit(True))).collect()] == [0.0, 0.0]
    one = spark.createDataFrame([(0, 0)], "doc_id bigint, toxic int")
    assert T.clean(docs, T.train(docs, one, F.lit(True))).count() == 2
    assert T.score(spark.createDataFrame([], DOCS), (None, 0.0)).count() == 0


def test_pooling_equals_a_plain_convolution():
    random_state = np.random.default_rng(5)
    texts = [b"a b c d", b"", b"b", b"c a"]
    features, first = T._features(texts)
    known = np.unique(features)
    vectors = random_state.normal(0, 1, (len(known) + 1, T.DIM)).astype(np.float32)
    vectors[-1] = 0
    filters = [random_state.normal(0, 1, (w * T.DIM, T.FILTERS)).astype(np.float32) for w in T.WIDTHS]
    biases = [random_state.normal(0, 1, T.FILTERS).astype(np.float32) for _ in T.WIDTHS]
    weights = random_state.normal(0, 1, T.FILTERS * 3).astype(np.float32)
    model = T.Model(known, vectors, filters, biases, weights, 0.3, np.zeros((len(known) + 1, 0)), np.zeros(1))
    got, _ = T.logits(model, texts)
    for i in range(len(texts)):
        x = vectors[T._rows(features[first[i] : first[i + 1]], known)].sum(1) if first[i + 1] > first[i] else np.zeros((0, T.DIM))
        x = np.concatenate((x, np.zeros((4, T.DIM))))
        pooled = []
        for w, kernel, bias in zip(T.WIDTHS, filters, biases):
            z = np.array([x[k : k + w].ravel() @ kernel + bias for k in range(len(x) - 2)])
            pooled.append(np.maximum(z.max(0), 0))
        assert got[i] == pytest.approx(np.concatenate(pooled) @ weights + 0.3, abs=1e-4)


def test_thresholds_follow_the_languages_of_the_sample(spark):
    pick = random.Random(9)
    rows = []
    for i in range(400):
        lang = "abcde"[i % 5]
        words = [f"{lang}{pick.randrange(40)}" for _ in range(30)] + ["moron"] * (i % 2)
        rows.append((i, " ".join(words), lang, i % 2))
    docs, labels = spark.createDataFrame([r[:3] for r in rows], "doc_id bigint, text string, lang string"), spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id bigint, toxic int")
    model, _ = T.train(docs.union(docs), labels, F.lit(True))
    assert len(model.shift) == 6
    data = [r[1].encode() for r in rows] + [b"", b"unheard"]
    z, told = T.logits(model, data)
    assert ["abcde"[k] for k in told[:400]] == [r[2] for r in rows] and told[400] == told[401] == 5
    assert [s >= 0.5 for s in 1 / (1 + np.exp(model.shift[told[:400]] - z[:400]))] == [bool(r[3]) for r in rows]
    alone, _ = T.train(docs.drop("lang"), labels, F.lit(True))
    assert len(alone.shift) == 1


def test_samples_hold_whole_texts_up_to_their_bytes(spark):
    rows = toxic_corpus(200)
    docs = small(spark, [(t, "en") for t, _ in rows])
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)], "doc_id bigint, toxic int")
    assert T.train(docs, labels, F.lit(True), sample_bytes=1) == (None, 0.0)
    assert G.train(docs, F.lit(True), sample_bytes=1)[1] == [] and G.train(docs, F.lit(True))[1] == ["en"]


def test_every_labelled_row_is_learned(spark, monkeypatch):
    """A word that only the rows of the greatest hashes hold, of more rows than one sample or part; parts are learned apart and again alike."""
    monkeypatch.setattr(T, "PART", 1500, raising=False)
    pick = random.Random(4)
    rows = [[i, " ".join(f"w{pick.randrange(60)}" for _ in range(8)), int(i % 3 == 0)] for i in range(4500)]
    toxic = sorted((r for r in rows if r[2]), key=lambda r: hashlib.md5(str(r[0]).encode()).hexdigest())
    late = {r[0] for r in toxic[1250:]}
    for r in toxic:
        r[1] += " zounds" if r[0] in late else " moron"
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id bigint, toxic int")
    model = T.train(docs, labels, F.lit(True))
    got = {r.doc_id: r.score for r in T.score(docs, model).collect()}
    assert all((got[i] >= 0.5) == bool(y) for i, _, y in rows) and len(late) == 250
    again = T.train(docs.repartition(7), labels, F.lit(True))
    assert {r.doc_id: r.score for r in T.score(docs, again).collect()} == got


def test_counts_and_thresholds_are_of_all_rows(spark, monkeypatch):
    """Words by language equal a plain count of every row, the threshold is the best of every row kept back; labels beyond a broadcast give the same."""
    monkeypatch.setattr(T, "PART", 300, raising=False)
    rows = [(i, t + f" only{i % 700}", "ab"[i % 2], y) for i, (t, y) in enumerate(toxic_corpus(4200, 8))]
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id bigint, toxic int")
    model, base = T.train(docs, labels, F.lit(True))
    assert base == sum(r[3] for r in rows) / len(rows)
    counts = np.full((len(model.known), 2), 0.5)
    for _, text, lang, _ in rows:
        spots = T._rows(T._features([text.encode()])[0], model.known)[:, 0]
        np.add.at(counts[:, "ab".index(lang)], spots[spots < len(model.known)], 1)
    odds = np.log(counts / counts.sum(0))
    assert model.speech[:-1] == pytest.approx(odds - odds.mean(1, keepdims=True), abs=1e-5)
    back = {r.doc_id for r in docs.filter(F.pmod(F.xxhash64(F.lit("kept back"), F.col("doc_id").cast("string")), F.lit(5)) == 0).collect()}
    z, _ = T.logits(model, [r[1].encode() for r in rows if r[0] in back])
    y = np.array([r[3] for r in rows if r[0] in back]) == 1

    def f1(cut):
        return 2 * (y & (z > cut)).sum() / ((z > cut).sum() + y.sum())

    assert f1(model.shift[-1]) == pytest.approx(max(f1(c) for c in z - 1e-6), abs=0.005)
    monkeypatch.setattr(T.bloom, "FEW", 10)
    other, _ = T.train(docs, labels, F.lit(True))
    assert (other.vectors == model.vectors).all() and (other.shift == model.shift).all()


@pytest.mark.parametrize("few", [0, 100_000])
def test_labelled_rows_are_dealt_whole(spark, monkeypatch, few):
    """Each part is in one task and each labelled text in one part, once, whichever way labels meet texts; ids may differ in type."""
    monkeypatch.setattr(T, "PART", 10)
    monkeypatch.setattr(T.bloom, "FEW", few)
    texts = spark.createDataFrame([(i % 300, f"text {i % 300}", None) for i in range(600)], "id bigint, text string, lang string").repartition(5)
    marked = spark.createDataFrame([(i, i % 2) for i in range(100, 400)], "id int, label int")
    rows = T._dealt(texts, marked, None).withColumn("task", F.spark_partition_id()).collect()
    assert sorted((r.text, r.label) for r in rows) == sorted((f"text {i}", i % 2) for i in range(100, 300))
    assert len({r.part for r in rows}) > 20 and len({(r.part, r.task) for r in rows}) == len({r.part for r in rows}) == len({r.task for r in rows})


def test_equally_likely_languages_give_the_first(spark):
    docs = small(spark, [("same words here", "b"), ("same words here", "a")])
    assert {r.lang_pred for r in G.identify(docs, G.train(docs, F.lit(True))).collect()} == {"a"}


def test_query_scores_equal_a_plain_convolution(spark, sf_dir):
    """op4's scores of whole texts, word by word and filter by filter, with the language told by summing its words."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model, _ = T.train(docs, labels, G.fold("doc_id", 5) != 0)
    got = {r.doc_id: r for r in Q.op4_toxicity(spark, sf_dir).collect()}
    assert len(got) == docs.count()
    for doc_id, text in [(r.doc_id, r.text) for r in docs.filter("n_chars < 6000").limit(60).collect()]:
        features, _ = T._features([text.encode()])
        rows = T._rows(features, model.known)
        x = np.concatenate((model.vectors[rows].sum(1), np.zeros((4, T.DIM)))) if len(rows) else np.zeros((4, T.DIM))
        pooled = [max(0.0, *(float(x[k : k + w].ravel() @ kernel[:, f] + bias[f]) for k in range(len(x) - 2))) for w, kernel, bias in zip(T.WIDTHS, model.filters, model.biases) for f in range(T.FILTERS)]
        z = sum(a * b for a, b in zip(pooled, model.weights)) + model.bias
        known = [r for r in rows[:, 0] if r < len(model.known)]
        language = int(np.argmax(sum(model.speech[r].astype(float) for r in known))) if known else model.speech.shape[1]
        assert got[doc_id].score == pytest.approx(1 / (1 + math.exp(-(z - model.shift[language]))), abs=1e-4)
        assert got[doc_id].predicted == int(got[doc_id].score >= 0.5) and got[doc_id].held_out == (zlib.crc32(str(doc_id).encode()) % 5 == 0)


def test_query_languages_equal_plain_sums(spark, sf_dir):
    """op6's predictions of whole texts, each word summed over its segmentations by itself."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names, languages, table = G.train(docs, G.fold("doc_id", 3) != 1)
    got = {r.doc_id: r for r in Q.op6_language(spark, sf_dir).collect()}
    words: dict[str, list[float]] = {}
    number = {p: i for i, p in enumerate(names)}

    def plain(word):
        if word not in words:
            marked, totals = "▁" + word, []
            for c in range(len(languages)):
                run = [1.0] + [0.0] * len(marked)
                for b in range(1, len(marked) + 1):
                    for a in range(max(0, b - G.PIECE), b):
                        p = table[number[marked[a:b]], c] if marked[a:b] in number else 0.0
                        run[b] += run[a] * (max(p, G.FLOOR) if b - a == 1 else p)
                totals.append(math.log(run[-1]))
            words[word] = totals
        return words[word]

    for doc_id, text in [(r.doc_id, r.text) for r in docs.filter("n_chars < 1500").limit(40).collect()]:
        own = G.words_of(text)
        if not own:
            assert (got[doc_id].lang_pred, got[doc_id].score) == ("und", 0.0)
            continue
        totals = [sum(plain(w)[c] for w in own) for c in range(len(languages))]
        even = [math.exp((t - max(totals)) * min(1.0, G.SURE / len(own))) for t in totals]
        assert got[doc_id].lang_pred == languages[totals.index(max(totals))]
        assert got[doc_id].score == pytest.approx(max(even) / sum(even), abs=1e-6)

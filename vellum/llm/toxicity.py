"""Toxicity: a convolutional text classifier on hashed word embeddings, trained in numpy.

A word's vector is the sum of the embeddings of its hash and of the hashes of its first 4, 5 and 6 bytes, so unseen
endings of a known stem are understood. Filters of 1, 2 and 3 words run over the text, each filter's largest value is
kept, and a linear layer gives the logit. Training takes every labelled row: the first dimension starts as each hash's log-odds
on the training texts, all weights are then learned by Adam on mini-batches; a fifth of the rows, chosen by a hash of the id, is kept
back, and on all of these a threshold is chosen for each language, which moves the logit so that 0.5 is the threshold. A text's
language is told from its words by naive Bayes, learned from the lang column of all labelled rows for whatever languages it holds; labels,
lang, source and doc_id are never inputs of a score.

Scale: labelled texts are dealt once into parts of about ``PART`` rows or ``PART_BYTES``. Words are counted by all tasks and summed by hash.
In each of ``ROUNDS`` rounds every part is learned by itself from the same model, and the mean of what the parts changed makes the
next one (iterative parameter mixing, McDonald et al. 2010). Responses to the rows kept back are counted in steps of 1/``STEPS``. Only
the model and counts of its size come to the driver, whatever the number of rows; scoring is one pass without a shuffle. A hash is
known that stands in ``SEEN`` training texts or more and in at least one of ``RARE`` of either label, so the model's size does not grow with the rows.

Defined cases: a null or empty text is scored like a text without known words; without rows of both labels every score
is the share of positives; texts without known words, and rows without languages, have the threshold of all; very long texts
are learned and scored whole, in blocks of texts; a repeated id counts once in training (the lower label, one of its texts);
repeated rows are scored each; equal texts get equal scores; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vellum.llm._arrow import runs, tidy
from vellum.llm._shared import drop_written, hashed_sample, written
from vellum.llm._text import blocks, many_hashes, word_spans
from vellum.operators import bloom

#: Rows and bytes of text of one part, which one learner takes in a round.
PART, PART_BYTES = 4096, 32_000_000
BITS, SEEN, RARE, DIM, FILTERS, WIDTHS, STEMS = 24, 3, 1200, 4, 6, (1, 2, 3), (4, 5, 6)
ROUNDS, BATCH, RATE, PRIOR, DECAY, SEED = 3, 64, 0.01, 4.0, 1e-4, 7
#: Steps of a unit of the logit, and the largest logit, between which thresholds are chosen.
STEPS, WIDEST = 256, 30
#: Changes are summed as whole numbers, so that their sums do not depend on the order of the parts.
FIXED = 2.0**40

GAPS = np.ones(256, bool)
for _a, _z in ((48, 58), (65, 91), (97, 123), (128, 256)):
    GAPS[_a:_z] = False


class Model(NamedTuple):
    known: np.ndarray  # sorted hashes
    vectors: np.ndarray  # one row a hash, and a last row of zeros
    filters: list[np.ndarray]  # by width: (width * DIM, FILTERS)
    biases: list[np.ndarray]
    weights: np.ndarray
    bias: float
    speech: np.ndarray  # log-odds of each language by known hash, and a last row of zeros
    shift: np.ndarray  # by language, and a last one for texts without a known word


def _features(data: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each word (whole and stems; one row a word), and the first word of each text."""
    buf, starts, ends, first = word_spans(data, GAPS)
    spans = [(starts, ends)] + [(starts, np.minimum(ends, starts + n)) for n in STEMS]
    whole, *stems = many_hashes(buf, spans)
    rows = np.stack([whole] + [s ^ np.uint64(n) for n, s in zip(STEMS, stems, strict=True)], 1) >> np.uint64(64 - BITS)
    return rows.astype(np.int64), first


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    run = np.concatenate((np.zeros((1, values.shape[1])), np.cumsum(values, 0, dtype=np.float64)))
    return run[first[1:]] - run[first[:-1]]


def _languages(rows: np.ndarray, first: np.ndarray, speech: np.ndarray) -> np.ndarray:
    """Number of each text's likeliest language; that behind the last language for a text without a known word."""
    n = speech.shape[1]
    if not n:
        return np.zeros(len(first) - 1, np.int64)
    some = _sums((rows[:, :1] < len(speech) - 1).astype(np.float32), first)[:, 0] > 0
    return np.where(some, _sums(speech[rows[:, 0]], first).argmax(1), n)


def _speech(known: np.ndarray, names: list[str], counted: pa.Table) -> np.ndarray:
    """Log-odds of each language by known hash, from (hash, lang, n) of the words; no columns without a language."""
    counts = np.full((len(known), len(names)), 0.5)
    number = {x: i for i, x in enumerate(names)}
    spots = np.searchsorted(known, counted.column("hash").to_numpy())
    np.add.at(counts, (spots, np.array([number[x] for x in counted.column("lang").to_pylist()], np.int64)), counted.column("n").to_numpy())
    odds = np.log(counts / counts.sum(0))
    out = np.zeros((len(known) + 1, len(names)), np.float32)
    out[:-1] = odds - odds.mean(1, keepdims=True) if len(names) else odds
    return out


def _rows(features: np.ndarray, known: np.ndarray, seen: np.ndarray | None = None) -> np.ndarray:
    """Row numbers of the embedding table; unknown hashes have the last one."""
    flat = features.ravel()
    out = np.full(len(flat), len(known), np.int64)
    some = np.flatnonzero(seen[flat]) if seen is not None else np.arange(len(flat))
    at = np.searchsorted(known, flat[some])
    ok = at < len(known)
    ok[ok] = known[at[ok]] == flat[some[ok]]
    out[some[ok]] = at[ok]
    return out.reshape(features.shape)


def _spread(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words when three empty words stand behind each text, and the first place of each text."""
    n = np.diff(first)
    starts = np.concatenate(([0], np.cumsum(n + 3)))
    return np.arange(first[-1]) + 3 * np.repeat(np.arange(len(n)), n), starts


def _pooled(x: np.ndarray, starts: np.ndarray, model: Model) -> np.ndarray:
    """Largest response of each filter in each text. ``x``: word vectors with gaps; rows past a text are zero."""
    out = []
    padded = np.concatenate((x, np.zeros((2, DIM), x.dtype)))
    own = np.stack((starts[:-1], starts[1:] - 2), 1).ravel()  # the last two places would reach into the next text
    for width, w, b in zip(WIDTHS, model.filters, model.biases, strict=True):
        z = sum(padded[k : k + len(x)] @ w[k * DIM : (k + 1) * DIM] for k in range(width)) + b
        out.append(np.maximum(np.maximum.reduceat(z, own, axis=0)[::2], 0))
    return np.concatenate(out, 1)


def logits(model: Model, data: list[bytes], seen: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Logit and language number of each text."""
    features, first = _features(data)
    place, starts = _spread(first)
    x = np.zeros((starts[-1], DIM), np.float32)
    rows = _rows(features, model.known, seen)
    x[place] = model.vectors[rows[:, 0]]
    for k in range(1, rows.shape[1]):
        x[place] += model.vectors[rows[:, k]]
    return _pooled(x, starts, model) @ model.weights + model.bias, _languages(rows, first, model.speech)


def _initial(known: np.ndarray, count: np.ndarray, hits: np.ndarray, base: float, speech: np.ndarray) -> Model:
    """The model before its first round: each known hash has its log-odds, from its texts and the toxic ones among them."""
    random = np.random.default_rng(SEED)
    share = (hits + PRIOR * base) / (count + PRIOR)
    vectors = random.normal(0, 0.01, (len(known) + 1, DIM)).astype(np.float32)
    vectors[:-1, 0] = (np.log(share / (1 - share)) - np.log(base / (1 - base))) / 4
    vectors[-1] = 0
    filters = [random.normal(0, 0.1, (w * DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
    for w, kernel in zip(WIDTHS, filters, strict=True):
        kernel[::DIM, 0] = 1 / w
    biases = [np.full(FILTERS, 0.0, np.float32) for _ in WIDTHS]
    weights = np.full(FILTERS * len(WIDTHS), 0.05, np.float32)
    weights[::FILTERS] = 1
    return Model(known, vectors, filters, biases, weights, -2.0, speech, np.zeros(speech.shape[1] + 1))


def _threshold(cells: np.ndarray, good: np.ndarray, bad: np.ndarray) -> float | None:
    """The logit that separates the labels best by F1, from the toxic and the other rows of each cell; None for too few rows."""
    if good.sum() < 5 or bad.sum() < 5:
        return None
    at, inverse = np.unique(cells, return_inverse=True)
    good, bad = np.bincount(inverse, good), np.bincount(inverse, bad)
    right, wrong = good.sum() - np.cumsum(good)[:-1], bad.sum() - np.cumsum(bad)[:-1]
    if not len(right):
        return None
    f = 2 * right / np.maximum(right + wrong + good.sum(), 1)
    cuts = (at[1:] + at[:-1] + 1) / 2 / STEPS  # between the cells
    return float(np.median(cuts[f == f.max()]))


def _descend(model: Model, rows: np.ndarray, first: np.ndarray, y: np.ndarray, balance: float, random) -> Model:
    """A pass of Adam on the logistic loss; only the places that hold a filter's largest value pass gradients on."""
    vectors, filters, biases, weights = model.vectors.copy(), [w.copy() for w in model.filters], [b.copy() for b in model.biases], model.weights.copy()
    bias = np.array([model.bias], np.float32)
    moments: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    step = 0

    def move(k: int, value: np.ndarray, grad: np.ndarray, at=None) -> None:
        m, v = moments.setdefault(k, (np.zeros_like(value), np.zeros_like(value)))
        spot = slice(None) if at is None else at
        m[spot] = 0.9 * m[spot] + 0.1 * grad
        v[spot] = 0.999 * v[spot] + 0.001 * grad * grad
        value[spot] -= RATE * (m[spot] / (1 - 0.9**step)) / (np.sqrt(v[spot] / (1 - 0.999**step)) + 1e-8)

    shuffled = random.permutation(len(y))
    for at in range(0, len(shuffled), BATCH):
        some, step = shuffled[at : at + BATCH], step + 1
        words = np.concatenate([np.arange(first[i], first[i + 1]) for i in some]) if len(some) else np.empty(0, np.int64)
        place, starts = _spread(np.concatenate(([0], np.cumsum(first[some + 1] - first[some]))))
        own = rows[words]
        x = np.zeros((starts[-1] + 2, DIM), np.float32)
        x[place] = vectors[own].sum(1)
        row_at = np.full((starts[-1] + 2, rows.shape[1]), len(vectors) - 1, np.int64)
        row_at[place] = own
        pooled, spots = [], []
        for width, w, b in zip(WIDTHS, filters, biases, strict=True):
            z = sum(x[k : k + starts[-1]] @ w[k * DIM : (k + 1) * DIM] for k in range(width)) + b
            spot = np.stack([z[a : e - 2].argmax(0) + a for a, e in zip(starts[:-1], starts[1:], strict=True)])
            pooled.append(np.take_along_axis(z, spot, 0)), spots.append(spot)
        hidden = np.concatenate(pooled, 1)
        active = np.maximum(hidden, 0)
        p = 1 / (1 + np.exp(-(active @ weights + bias[0])))
        error = (p - y[some]) * np.where(y[some] == 1, balance, 1) / len(some)
        back = error[:, None] * weights[None, :] * (hidden > 0)
        touched, change = [], []
        for i, (width, w) in enumerate(zip(WIDTHS, filters, strict=True)):
            g, spot = back[:, i * FILTERS : (i + 1) * FILTERS], spots[i]
            grad = np.zeros_like(w)
            for k in range(width):
                here = x[spot + k]
                grad[k * DIM : (k + 1) * DIM] = np.einsum("bf,bfd->df", g, here)
                flow = g[:, :, None] * w[k * DIM : (k + 1) * DIM].T[None]
                for r in range(rows.shape[1]):
                    touched.append(row_at[spot + k, r].ravel()), change.append(flow.reshape(-1, DIM))
            move(10 + i, filters[i], grad)
            move(20 + i, biases[i], g.sum(0))
        ids, inverse = np.unique(np.concatenate(touched), return_inverse=True)
        total = np.zeros((len(ids), DIM), np.float32)
        np.add.at(total, inverse, np.concatenate(change))
        real = ids < len(vectors) - 1
        move(1, vectors, total[real] + DECAY * vectors[ids[real]], ids[real])
        move(2, weights, active.T @ error)
        np.maximum(weights, 0, out=weights)  # toxic words add up; no other words can excuse them
        move(3, bias, np.array([error.sum()], np.float32))
    return model._replace(vectors=vectors, filters=filters, biases=biases, weights=weights, bias=float(bias[0]))


def _dense(model: Model) -> np.ndarray:
    """All weights but the embeddings, in one row."""
    return np.concatenate([x.ravel() for x in (*model.filters, *model.biases, model.weights)] + [[model.bias]]).astype(np.float64)


def _moved(model: Model, spots: np.ndarray, steps: np.ndarray) -> Model:
    """The model with steps added to rows of its embeddings, and behind them to its other weights."""
    vectors, dense = model.vectors.copy(), _dense(model)
    own = spots < len(vectors)
    vectors[spots[own]] += steps[own].astype(np.float32)
    dense[spots[~own] - len(vectors)] += steps[~own, 0]
    shapes = [x.shape for x in (*model.filters, *model.biases, model.weights)]
    ends = np.cumsum([int(np.prod(x)) for x in shapes])
    parts = [x.reshape(shape).astype(np.float32) for x, shape in zip(np.split(dense, ends)[:-1], shapes, strict=True)]
    k = len(WIDTHS)
    return model._replace(vectors=vectors, filters=parts[:k], biases=parts[k : 2 * k], weights=parts[-1], bias=float(dense[-1]))


@tidy
def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows (label, held, lang, text): texts of each hash that are not kept back (n) with the toxic ones (hits); words of each hash by language."""
    mask = (1 << BITS) - 1
    for batch in batches:
        label, held = batch.column(0).to_numpy(zero_copy_only=False) == 1, batch.column(1).to_numpy(zero_copy_only=False)
        names = batch.column(2).unique().drop_null()
        lang = pa.compute.index_in(batch.column(2), names).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        found = [(np.empty(0, np.int64), np.empty(0, np.int64))] * 2
        for at, data in blocks(batch.column(3).to_pylist()):  # each hash counts once a text
            features, first = _features(data)
            owner = np.repeat(np.arange(at, at + len(data)), np.diff(first))
            pairs = np.unique((features + (owner[:, None] << BITS))[~held[owner]])
            once, own = (pairs & mask) * 2 + label[pairs >> BITS], lang[owner]
            words = features[own >= 0, 0] + (own[own >= 0] << BITS)
            found = [_added(have, np.unique(new, return_counts=True)) for have, new in zip(found, (once, words), strict=True)]
        (once, times), (words, said) = found
        yield pa.RecordBatch.from_arrays([pa.array(once >> 1, pa.int32()), pa.nulls(len(once), pa.string()), pa.array(times), pa.array(times * (once & 1))], ["hash", "lang", "n", "hits"])
        yield pa.RecordBatch.from_arrays([pa.array(words & mask, pa.int32()), names.take(pa.array(words >> BITS)), pa.array(said), pa.array(np.zeros(len(said), np.int64))], ["hash", "lang", "n", "hits"])


def _added(have: tuple[np.ndarray, np.ndarray], new: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two lists of (key, count) as one, each key once."""
    keys, at = np.unique(np.concatenate((have[0], new[0])), return_inverse=True)
    return keys, np.bincount(at, np.concatenate((have[1], new[1]))).astype(np.int64)


def _learner(shared, balance: float, turn: int):
    """The change of the model by each part of rows (part, label, text), as (spot, steps); weights behind the embeddings have one step."""

    @tidy
    def learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        seen = np.zeros(1 << BITS, bool)
        seen[model.known] = True
        for (part,), some in runs(batches, 1):
            rows, sizes = [], []
            for _, data in blocks(some.column(2).to_pylist()):
                features, first = _features(data)
                rows.append(_rows(features, model.known, seen).astype(np.int32)), sizes.append(np.diff(first))
            first = np.concatenate(([0], np.cumsum(np.concatenate(sizes))))
            y = some.column(1).to_numpy().astype(np.float32)
            mine = _descend(model, np.concatenate(rows), first, y, balance, np.random.default_rng((SEED, turn, part)))
            change = mine.vectors.astype(np.float64) - model.vectors
            spots = np.flatnonzero(change.any(1))
            dense = _dense(mine) - _dense(model)
            steps = np.zeros((len(spots) + len(dense), DIM))
            steps[: len(spots)], steps[len(spots) :, 0] = change[spots], dense
            at = np.concatenate((spots, len(model.vectors) + np.arange(len(dense))))
            steps = np.rint(steps * FIXED).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at), *(pa.array(steps[:, k]) for k in range(DIM))], ["spot", *(f"d{k}" for k in range(DIM))])

    return learned


def _tallier(shared):
    """From rows (label, text): toxic and other rows of each language and cell of the logit."""

    @tidy
    def tallied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        seen = np.zeros(1 << BITS, bool)
        seen[model.known] = True
        for batch in batches:
            for at, data in blocks(batch.column(1).to_pylist()):
                z, language = logits(model, data, seen)
                cell = np.floor(np.clip(z, -WIDEST, WIDEST) * STEPS).astype(np.int64)
                toxic = (batch.column(0).to_numpy()[at : at + len(data)] == 1).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(language.astype(np.int64)), pa.array(cell), pa.array(toxic), pa.array(1 - toxic)], ["language", "cell", "good", "bad"])

    return tallied


def _thresholds(rows: DataFrame, model: Model) -> np.ndarray:
    """Thresholds by language and, last, for all, from every row kept back; languages with few of them lean on all, few of all on every row."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def tally(some: DataFrame) -> list[np.ndarray]:
        cells = some.select("label", "text").mapInArrow(_tallier(shared), "language bigint, cell bigint, good bigint, bad bigint")
        got = cells.groupBy("language", "cell").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).toArrow()  # at most the cells of each language
        return [got.column(c).to_numpy() for c in ("language", "cell", "good", "bad")]

    language, *cells = tally(rows.filter("held"))
    whole = _threshold(*cells)
    if whole is None:
        whole = _threshold(*tally(rows)[1:]) or 0.0
    own = [_threshold(*(c[language == k] for c in cells)) for k in range(model.speech.shape[1])]
    shared.unpersist()
    return np.array([whole if x is None else x for x in own] + [whole])


def _marked(labels: DataFrame, usable: F.Column, positives: int | None, negatives: int | None, id_col: str, label_col: str) -> DataFrame:
    """(id, label) of the labelled rows, each id once."""
    marked = labels.filter(usable).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    marked = marked.filter(F.col("id").isNotNull() & F.col("label").isin(0, 1)).groupBy("id").agg(F.min("label").alias("label"))
    if positives is None and negatives is None:
        return marked
    most = [2**62 if x is None else x for x in (positives, negatives)]
    return hashed_sample(marked, "label", F.when(F.col("label") == 1, most[0]).otherwise(most[1]))


@tidy
def _once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of each id of sorted rows, whose last column is the id, without it."""
    last = None
    for batch in batches:
        keys = batch.column(batch.num_columns - 1).to_pylist()
        fresh = [k != before for k, before in zip(keys, [last, *keys], strict=False)]
        last = keys[-1] if keys else last
        yield batch.select(batch.schema.names[:-1]).filter(pa.array(fresh, pa.bool_()))


def _dealt(texts: DataFrame, marked: DataFrame, sample_bytes: int | None) -> DataFrame:
    """The labelled rows of (id, lang, text) in parts, one of each id, in the order of a hash; a fifth is marked as kept back.

    A part is what Spark's hash of the id gives one task, so labels meet texts where these are dealt to. Few labels are broadcast; of more a
    Bloom filter keeps texts without one from moving.
    """
    marked = marked.withColumn("id", F.col("id").cast(texts.schema["id"].dataType))
    n, mean = marked.count(), texts.agg(F.coalesce(F.avg(F.octet_length("text")), F.lit(0.0))).first()[0]
    parts = max(1, -(-n // PART), math.ceil(n * mean / PART_BYTES))
    slices = bloom.slices_for(n)
    if n <= bloom.FEW:
        rows = texts.join(F.broadcast(marked), "id").repartition(parts, "id")
    else:
        if slices <= bloom.MOST:
            texts = bloom.with_hits(texts, "id", bloom.bloom_filter(marked, "id", slices), slices).filter("_hit").drop("_hit")
        rows = texts.repartition(parts, "id").join(marked.repartition(parts, "id"), "id")
    rows = rows.withColumn("key", F.col("id").cast("string"))
    if sample_bytes is not None:
        size = F.sum(F.octet_length("text")).over(Window.partitionBy("label").orderBy(F.md5("key"), "key", F.xxhash64("text"), "lang").rowsBetween(Window.unboundedPreceding, 0))
        rows = rows.withColumn("size", size).filter(F.col("size") <= sample_bytes).repartition(parts, "id")
    held = F.pmod(F.xxhash64(F.lit("kept back"), "key"), F.lit(5)) == 0
    dealt = rows.select(F.pmod(F.hash("id"), F.lit(parts)).alias("part"), "label", "lang", "text", held.alias("held"), "key")
    return dealt.sortWithinPartitions("part", F.md5("key"), "key", F.xxhash64("text"), "lang").mapInArrow(_once, "part int, label int, lang string, text string, held boolean")


def _fitted(rows: DataFrame) -> tuple[Model | None, float]:
    spark = rows.sparkSession
    sizes = {(r.held, r.label): r.n for r in rows.groupBy("held", "label").agg(F.count("*").alias("n")).collect()}
    n, toxic = sum(sizes.values()), sizes.get((True, 1), 0) + sizes.get((False, 1), 0)
    if toxic in (0, n):
        return None, toxic / max(n, 1)
    bad, good = sizes.get((False, 0), 0), sizes.get((False, 1), 0)
    if not bad or not good:  # so few rows that all of a label are kept back
        rows, bad, good = rows.withColumn("held", F.lit(False)), n - toxic, toxic
    counted = rows.select("label", "held", "lang", "text").mapInArrow(_counter, "hash int, lang string, n bigint, hits bigint")
    sums = written(counted.groupBy("hash", "lang").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits")), "words")
    common = (F.col("hits") * RARE >= good) | ((F.col("n") - F.col("hits")) * RARE >= bad)
    wanted = sums.filter(F.col("lang").isNull() & (F.col("n") >= (SEEN if n > 1000 else 2)) & common)
    table = wanted.select("hash", "n", "hits").toArrow().sort_by("hash")
    known, count, hits = (table.column(c).to_numpy() for c in ("hash", "n", "hits"))
    said = sums.filter(F.col("lang").isNotNull())
    names = sorted(r.lang for r in rows.select("lang").filter("lang IS NOT NULL").distinct().collect())
    speech = _speech(known, names, said.join(F.broadcast(wanted.select("hash")), "hash").select("hash", "lang", "n").toArrow())  # a model's known hashes
    model = _initial(known.astype(np.int64), count, hits, float(np.clip(good / (good + bad), 1e-3, 1 - 1e-3)), speech)
    for turn in range(ROUNDS):
        shared = spark.sparkContext.broadcast(model._replace(speech=speech[:0]))
        train = rows.filter(~F.col("held")).select("part", "label", "text")
        steps = train.mapInArrow(_learner(shared, (bad / good) ** 0.5, turn), "spot bigint, " + ", ".join(f"d{k} bigint" for k in range(DIM)))
        mean = steps.groupBy("spot").agg(F.count("*").alias("n"), *(F.sum(f"d{k}").alias(f"d{k}") for k in range(DIM))).toArrow()  # at most the model
        model = _moved(model, mean.column("spot").to_numpy(), np.stack([mean.column(f"d{k}").to_numpy() for k in range(DIM)], 1) / FIXED / mean.column("n").to_numpy()[:, None])
        shared.unpersist()
    drop_written(sums)
    return model._replace(shift=_thresholds(rows, model)), toxic / n


def train(docs: DataFrame, labels: DataFrame, usable: F.Column, positives: int | None = None, negatives: int | None = None, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", lang_col: str = "lang", sample_bytes: int | None = None) -> tuple[Model | None, float]:
    """The model and the share of positives, from every labelled row that ``usable`` marks.

    Callers that want a bounded sample may give the most rows of each label, or the most bytes of each label's texts; nothing is bounded otherwise.
    Without a column ``lang_col`` all texts share one threshold.
    """
    lang = F.col(lang_col).cast("string") if lang_col in docs.columns else F.lit(None).cast("string")
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), lang.alias("lang")).filter("text IS NOT NULL")
    dealt = written(_dealt(texts, _marked(labels, usable, positives, negatives, id_col, label_col), sample_bytes), "dealt")
    model = _fitted(dealt)
    drop_written(dealt)
    return model


def _scorer(shared, text_at: int, keep: bool):
    """Scores of each row beside its first column, or with ``keep`` the rows below the threshold as they are."""

    @tidy
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, base = shared.value
        seen = None
        if model is not None:
            seen = np.zeros(1 << BITS, bool)
            seen[model.known] = True
        for batch in batches:
            out = []
            if model is None:
                out = [np.full(batch.num_rows, base)]
            else:
                for _, data in blocks(x.as_py() for x in batch.column(text_at)):
                    z, language = logits(model, data, seen)
                    out.append(1 / (1 + np.exp(-np.clip(z - model.shift[language], -30, 30))))
            scores = np.concatenate(out).astype(np.float64) if out else np.empty(0)
            if keep:
                yield batch.filter(pa.array(scores < 0.5))
                continue
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    return score


def score(docs: DataFrame, model: tuple[Model | None, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of each row; 0.5 is the threshold of the text's language."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return slim.mapInArrow(_scorer(shared, 1, False), f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, score double")


def clean(docs: DataFrame, model: tuple[Model | None, float], text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below 0.5, in all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_scorer(shared, docs.columns.index(text_col), True), docs.schema)

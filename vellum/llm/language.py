"""Language identification with unigram piece models, summed over all segmentations.

The vocabulary is a fixed public one; only the probability of each piece in each language is learned, by
expectation-maximisation on a bounded sample of labelled documents. A word's probability in a language is the sum
over all its segmentations into pieces, computed by a forward algorithm for many different words at once. A text's score
adds its words' log-probabilities.

Scale: training reads ``PER_LANGUAGE`` documents of each language (a documented bound, chosen by a hash of the id, and no more whole
texts than fit ``SAMPLE_BYTES``); each language is learned by a task of its own, and only its piece probabilities come
to the driver. Scoring is one pass without a shuffle, in blocks of texts, and what is broadcast is one row a piece.

Defined cases: null texts and texts without letters give ``und`` with score 0; a word of any
length is summed over all its segmentations, and from ``LONGEST`` letters on it counts as several words of evidence and is learned
in parts; very long texts are scored whole; of equally likely languages the first by name is given; without any
labelled row every text is ``und``; null languages are never learned; a repeated id counts once in training, repeated
rows are scored each; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm._arrow import tidy
from vellum.llm._shared import broadcast_if_small, hashed_sample

#: Labelled documents of each language that are used for training.
PER_LANGUAGE = 300
#: The most bytes of a language's texts that training takes, in whole texts.
SAMPLE_BYTES = 64_000_000
#: Characters of text whose different words are scored together.
TOGETHER = 3_000_000
#: Partitions over which languages are dealt for training.
LEARNERS = 32
LONGEST, PIECE, ROUNDS, FLOOR, BOOST = 32, 16, 3, 1e-7, 16.0
#: Letters up to which words are scored together, letters of words that are scored at once, and letters of a longer word looked up at once.
WIDEST, CELLS, STRETCH = 256, 660_000, 4_096
#: Words after which more evidence does not make a score surer.
SURE = 8
WORDS = re.compile(r"[^\W\d_]+")
_BASE = np.uint64(0x100000001B3)


def words_of(text: str) -> list[str]:
    return WORDS.findall(text.lower())


def parts_of(words: list[str]) -> list[str]:
    """Words with long ones in parts of ``LONGEST - 1`` letters, for training."""
    if any(len(w) >= LONGEST for w in words):
        words = [w[i : i + LONGEST - 1] for w in words for i in range(0, len(w), LONGEST - 1)]
    return words


def evidence(words: list[str]) -> int:
    """How many words a text counts for: a long one counts once for every ``LONGEST - 1`` letters begun."""
    return sum(-(-len(w) // (LONGEST - 1)) for w in words)


def vocabulary(path: str | None = None) -> list[str]:
    """The vocabulary's pieces of letters; a word's beginning is marked by U+2581."""
    import public_tokenizers
    import sentencepiece

    own = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path("piece_bpe_32k.model"))
    pieces = (own.id_to_piece(i) for i in range(own.get_piece_size()))
    return sorted({p.lower() for p in pieces if 1 <= len(p) <= PIECE and p.lstrip("▁").isalpha()})


def _matrix(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the marked words, one row each, and their lengths."""
    marked = np.array(["▁" + w for w in words])
    codes = marked.view(np.uint32).reshape(len(words), -1)
    return codes.astype(np.uint64), np.char.str_len(marked)


def _hashes(codes: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(start, end, hash) of every substring of up to PIECE characters, for all words at once; ends ascend."""
    width = codes.shape[1]
    rolled: dict[int, np.ndarray] = {}
    for end in range(1, width + 1):
        fresh = {}
        for start in range(max(0, end - PIECE), end):
            fresh[start] = (rolled[start] if start < end - 1 else np.zeros(len(codes), np.uint64)) * _BASE + codes[:, end - 1] + np.uint64(1)
            yield start, end, fresh[start]
        rolled = fresh


class Pieces:
    """Finds piece numbers by hash; unknown pieces have the last number."""

    SLOTS = 1 << 20

    def __init__(self, pieces: list[str]) -> None:
        keys = np.array([self._of(p) for p in pieces], np.uint64)
        by = np.argsort(keys)
        self.keys, self.numbers, self.n = keys[by], by, len(pieces)
        self.slot = np.full(self.SLOTS, -1, np.int32)
        place = self._place(keys)
        self.slot[place] = np.arange(len(pieces))
        self.own = keys
        self.crowded = set(np.flatnonzero(self.slot[place] != np.arange(len(pieces))).tolist())
        self.more = {int(keys[i]): i for i in self.crowded}

    @staticmethod
    def _of(piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * int(_BASE) + ord(c) + 1) % 2**64
        return h

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        got = self.slot[self._place(hashes)]
        wrong = (got < 0) | (self.own[got] != hashes)
        if self.more and wrong.any():  # pieces that share a slot with another
            odd = np.flatnonzero(wrong & (got >= 0))
            got = got.copy()
            for i in odd:
                number = self.more.get(int(hashes[i]))
                if number is not None:
                    got[i], wrong[i] = number, False
        return np.where(wrong, self.n, got)


def _lattice(words: list[str], pieces: Pieces) -> tuple[list[tuple[int, int, np.ndarray]], np.ndarray, np.ndarray]:
    codes, lengths = _matrix(words)
    return [(a, b, pieces.find(h)) for a, b, h in _hashes(codes)], codes, lengths


def _step(table: np.ndarray, a: int, b: int, numbers: np.ndarray) -> np.ndarray:
    """Probabilities of the pieces from a to b; a character alone always has at least the floor."""
    p = table[numbers] * BOOST ** (b - a)
    return np.maximum(p, FLOOR * BOOST) if b - a == 1 else p


def word_scores(words: list[str], pieces: Pieces, table: np.ndarray) -> np.ndarray:
    """Natural log-probability of each word in each language, summed over all segmentations. ``table``: pieces + 1 rows.

    Words of up to ``WIDEST`` letters go together, sorted by length; a longer one goes alone, letter by letter.
    """
    out = np.zeros((len(words), table.shape[1]))
    sizes = np.array([len(w) for w in words])
    by = np.argsort(sizes, kind="stable")
    together = by[: np.searchsorted(sizes[by], WIDEST, "right")]
    at = 0
    while at < len(together):
        fits = np.arange(1, min(20_000, len(together) - at) + 1) * (sizes[together[at : at + 20_000]] + 1) <= CELLS
        rows = together[at : at + max(1, int(fits.sum()))]
        out[rows] = _scores_together([words[i] for i in rows], pieces, table)
        at += len(rows)
    for i in by[len(together) :]:
        out[i] = _score_alone(words[i], pieces, table)
    return out


def _scores_together(words: list[str], pieces: Pieces, table: np.ndarray) -> np.ndarray:
    codes, lengths = _matrix(words)
    out, scale = np.zeros((len(words), table.shape[1])), np.zeros((len(words), table.shape[1]))
    forward = {0: np.ones((len(words), table.shape[1]))}
    for a, b, hashes in _hashes(codes):
        add = forward[a] * _step(table, a, b, pieces.find(hashes))
        forward[b] = forward[b] + add if b in forward else add
        if b - a == 1:
            forward.pop(b - PIECE, None)
            done = np.flatnonzero(lengths == b)
            if len(done):
                out[done] = np.log(forward[b][done]) + scale[done] - b * np.log(BOOST)
            if b % PIECE == 0:  # sums of long words stay far from zero
                level = forward[b]
                forward = {end: sums / level for end, sums in forward.items()}
                scale += np.log(level)
    return out


def _score_alone(word: str, pieces: Pieces, table: np.ndarray) -> np.ndarray:
    """The same for one very long word: its substrings are looked up by stretches, its sums run on from letter to letter."""
    codes = np.array(["▁" + word]).view(np.uint32).astype(np.uint64)
    sums, scale = np.zeros((PIECE, table.shape[1])), np.zeros(table.shape[1])
    sums[0] = 1  # sums[k]: all segmentations of what ends k letters before
    for start in range(0, len(codes), STRETCH):
        stop = min(start + STRETCH, len(codes))
        ends = np.arange(start + 1, stop + 1)
        first = max(0, start - PIECE)  # letters before the stretch that its substrings may begin with
        own = codes[first:stop]
        steps, hashes = np.zeros((len(ends), PIECE, table.shape[1])), np.zeros(len(own) + 1, np.uint64)
        for size in range(1, PIECE + 1):
            hashes = np.concatenate([np.zeros(1, np.uint64), hashes[:-1] * _BASE + own + np.uint64(1)])
            whole = np.flatnonzero(ends >= size)
            steps[whole, size - 1] = _step(table, 0, size, pieces.find(hashes[ends[whole] - first]))
        for i, step in enumerate(steps):
            now = (sums * step).sum(0)
            sums = np.concatenate([now[None], sums[:-1]])
            if i % PIECE == 0:
                sums, scale = sums / now, scale + np.log(now)
    return np.log(sums[0]) + scale - len(codes) * np.log(BOOST)


def learn(counts: dict[str, Counter], pieces: Pieces) -> tuple[list[str], np.ndarray]:
    """Languages and the table of piece probabilities, from word counts by language."""
    languages = sorted(counts)
    table = np.zeros((pieces.n + 1, len(languages)))
    for column, language in enumerate(languages):
        words = sorted(counts[language], key=lambda w: (len(w), w))
        weight = np.array([counts[language][w] for w in words], float)
        own = np.full((pieces.n + 1, 1), 1.0 / max(pieces.n, 1))
        own[pieces.n] = 0
        for _ in range(ROUNDS):
            got = np.zeros(pieces.n + 1)
            for at in range(0, len(words), 20_000):
                some, w = words[at : at + 20_000], weight[at : at + 20_000]
                lattice, codes, lengths = _lattice(some, pieces)
                width = codes.shape[1]
                forward, backward = np.zeros((width + 1, len(some))), np.zeros((width + 1, len(some)))
                forward[0] = 1
                probability = [_step(own, a, b, numbers)[:, 0] for a, b, numbers in lattice]
                for (a, b, _), p in zip(lattice, probability, strict=True):
                    forward[b] += forward[a] * p
                backward[lengths, np.arange(len(some))] = 1
                for (a, b, _), p in zip(reversed(lattice), reversed(probability), strict=True):
                    backward[a] += np.where(b <= lengths, p * backward[b], 0)
                total = forward[lengths, np.arange(len(some))]
                for (a, b, numbers), p in zip(lattice, probability, strict=True):
                    share = np.where(b <= lengths, w * forward[a] * p * backward[b] / total, 0)
                    got += np.bincount(numbers, share, pieces.n + 1)
            got += 1e-3
            got[pieces.n] = 0
            own = (got / got.sum())[:, None]
        table[:, column] = own[:, 0]
    return languages, table


def _learner(names: list[str], limit: int):
    """Learns each language from its rows (lang, text, id), which come in the order of the sample."""

    @tidy
    def learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, words, seen, size = None, Counter(), set(), 0

        def done() -> Iterator[pa.RecordBatch]:
            if words:
                table = learn({now: words}, Pieces(names))[1]
                yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([table[:, 0].tobytes()], pa.binary())], ["lang", "odds"])

        for batch in batches:
            for lang, text, key in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if lang != now:
                    yield from done()
                    now, words, seen, size = lang, Counter(), set(), 0
                size += len(text.encode("utf-8", "surrogatepass"))
                if key not in seen and size <= limit:
                    seen.add(key)
                    words.update(parts_of(words_of(text)))
        yield from done()

    return learned


def train(docs: DataFrame, usable: F.Column, per_language: int = PER_LANGUAGE, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_bytes: int = SAMPLE_BYTES) -> tuple[list[str], list[str], np.ndarray]:
    """Pieces, languages and probabilities, learned from a bounded sample of the rows that ``usable`` marks."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), usable.alias("ok")).filter(F.col("ok") & F.col("lang").isNotNull())
    chosen = broadcast_if_small(hashed_sample(rows.select("id", "lang").distinct(), "lang", F.lit(per_language)))
    texts = docs.join(chosen, (docs[id_col] == chosen.id) & (docs[lang_col] == chosen.lang)).select(chosen.lang, docs[text_col].alias("text"), chosen.id.cast("string").alias("key"))
    sample = texts.filter("text IS NOT NULL").repartition(LEARNERS, "lang").sortWithinPartitions("lang", F.md5("key"), "key", F.xxhash64("text"))
    names = vocabulary(path)
    got = sorted(sample.mapInArrow(_learner(names, sample_bytes), "lang string, odds binary").collect())  # one row a language
    table = np.stack([np.frombuffer(r["odds"]) for r in got], 1) if got else np.zeros((len(names) + 1, 0))
    return names, [r["lang"] for r in got], table


def _scorer(model, text_at: int, least: float | None):
    """Language and score beside the first column, or with ``least`` the rows that score it, as they are."""

    @tidy
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, languages, table = model.value
        pieces = Pieces(names)
        for batch in batches:
            labels, scores, held, size = [], [], [], 0
            texts = batch.column(text_at)

            def flush() -> None:
                words, sizes = [], []
                for text in held:
                    own = words_of(text) if text and any(map(str.isalpha, text)) else []
                    words += own
                    sizes.append((len(own), evidence(own)))
                codes, unique = pd.factorize(np.array(words, dtype=object)) if words else (np.empty(0, np.int64), [])
                by_word = word_scores(list(unique), pieces, table) if len(unique) and languages else None
                at = 0
                for n, weight in sizes:
                    if not n or by_word is None:
                        labels.append("und"), scores.append(0.0)
                        continue
                    total = by_word[codes[at : at + n]].sum(0)
                    even = np.exp((total - total.max()) * min(1.0, SURE / weight))
                    best = int(total.argmax())
                    labels.append(languages[best]), scores.append(float(even[best] / even.sum()))
                    at += n

            for i in range(batch.num_rows):
                text = texts[i].as_py()
                held.append(text)
                size += len(text or "")
                if size > TOGETHER:
                    flush()
                    held, size = [], 0
            if held:
                flush()
            if least is not None:
                yield batch.filter(pa.array([s >= least for s in scores], pa.bool_()))
                continue
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(labels, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    return score


def identify(docs: DataFrame, model: tuple[list[str], list[str], np.ndarray], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of each row."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return slim.mapInArrow(_scorer(shared, 1, None), f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")


def told(docs: DataFrame, model: tuple[list[str], list[str], np.ndarray], least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language can be told with a score of ``least`` or more, in all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_scorer(shared, docs.columns.index(text_col), least), docs.schema)


def fold(id_col: str, n: int) -> F.Column:
    """crc32 of the id as text, modulo n; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(n))

"""Word hashing over whole blocks of text with numpy.

A block of texts is one byte buffer; every word gets a 64-bit hash from a running polynomial
over the bytes, so no Python code runs per word. Used inside Spark tasks only.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

_MULT = np.uint64(0x9E3779B97F4A7C15)
_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_SEED = 20240229
BLOCK_BYTES = 1 << 20


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of SplitMix64 (Steele, Lea and Flood 2014)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_table(fold_case: bool = True) -> np.ndarray:
    table = mix64(np.arange(256, dtype=np.uint64) + np.uint64(_SEED))
    if fold_case:
        table[65:91] = table[97:123]
    return table


_TABLE = _byte_table()
WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        have = np.full(max(n, BLOCK_BYTES + 64), base, np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if n <= 4 * BLOCK_BYTES:
            _powers[name] = have
    return have[:n]


def blocks(texts: Iterable[str | None], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of consecutive texts of about ``limit`` bytes: (index of the first, encoded texts)."""
    first, held, size = 0, [], 0
    for i, text in enumerate(texts):
        data = b"" if text is None else text.encode("utf-8", "surrogatepass")
        if held and size + len(data) > limit:
            yield first, held
            first, held, size = i, [], 0
        held.append(data)
        size += len(data) + 1
    if held:
        yield first, held


def word_spans(data: list[bytes], breaks: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buffer of the joined texts, start and end of each word, and the first word of each text (one more at the end)."""
    buf = np.frombuffer(b" ".join(data) + b" ", np.uint8)
    sizes = np.fromiter((len(d) + 1 for d in data), np.int64, len(data))
    word = ~breaks[buf]
    edge = np.flatnonzero(word[1:] != word[:-1]) + 1
    if word[0]:
        edge = np.concatenate(([0], edge))
    starts, ends = edge[0::2], edge[1::2]
    doc_end = np.cumsum(sizes)
    return buf, starts, ends, np.concatenate(([0], np.searchsorted(starts, doc_end)))


def many_hashes(buf: np.ndarray, spans: list[tuple[np.ndarray, np.ndarray]], table: np.ndarray = _TABLE) -> list[np.ndarray]:
    """A 64-bit hash of each span of bytes, for several lists of (starts, ends)."""
    n = len(buf)
    run = np.empty(n + 1, np.uint64)
    run[0] = 0
    np.cumsum(table[buf] * _power("up", _MULT, n), out=run[1:])
    down = _power("down", _INV, n)
    return [mix64((run[ends] - run[starts]) * down[starts] + (ends - starts).astype(np.uint64)) for starts, ends in spans]


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes."""
    return many_hashes(buf, [(starts, ends)])[0]


def shingle_hashes(words: np.ndarray, first: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its ``width``-word shingles; a shorter text is one shingle."""
    mult = mix64(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)
    n = len(words)
    rolled = np.zeros(max(n - width + 1, 0), np.uint64)
    for k in range(width):
        rolled += mult[k] * words[k : n - width + 1 + k] if len(rolled) else rolled
    rolled = mix64(rolled)
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= width:
            yield np.unique(rolled[a : b - width + 1])
        elif b > a:
            own = mix64(np.sum(mult[: b - a] * words[a:b], dtype=np.uint64, keepdims=True) + np.uint64(b - a))
            yield own
        else:
            yield np.empty(0, np.uint64)

"""Best-fit packing of token sequences under several capacities at once.

A sequence has room for so many tokens, so many documents and so much attention cost (the sum of the squared
lengths of its pieces). Pieces are placed from the longest to the shortest. Of the sequences with room under every
capacity a piece goes to the one whose weighted residual vector has the smallest norm afterwards, or with
``rule="dot"`` to the one whose residual has the largest weighted dot product with the piece.

1. One pass tokenizes; only (id, piece, start, length, checksum) leaves it and is written out, never the ids.
2. The number of groups follows from the count of pieces; pieces are dealt to groups by a hash of id and start, so groups have
   about ``GROUP`` pieces whatever the data are like, and each is packed by one task. A group leaves about one
   sequence partly filled, a few hundredths of a percent of all.

Documents longer than a sequence are cut into whole ones; their first piece holds the rest. The default capacities of
documents and cost equal what the token capacity allows anyway, so they never cost a sequence; set them lower to bind.
Ties between sequences go to the one that was opened first and is still in its place, so equal input is packed alike.

Defined cases: a null or empty text is one closing token; a very long text is cut whole, nothing is left out; the literal of an added token is that token, as in the JSON form; repeated rows are packed each; a null id is kept;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm._arrow import runs, tidy
from vellum.llm._shared import written
from vellum.llm._tokens import json_token_ids

CAPACITY, CLOSING, GROUP = 2048, 0, 4096
#: The most shuffle partitions; a task packs the groups of its partition one after another.
PARTITIONS = 4096


def cut_points(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``total`` ids."""
    rest = total % capacity
    starts = ([0] if rest else []) + list(range(rest, total, capacity))
    return [(s, (rest if s == 0 and rest else capacity)) for s in starts]


def _cutter(capacity: int, path: str | None, json_path: str | None):
    @tidy
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, piece, start, length, crc = [], [], [], [], []
            texts = batch.column(1)
            for i in range(batch.num_rows):
                ids = np.append(json_token_ids(texts[i].as_py(), path, json_path), np.uint32(CLOSING)).astype("<u4")
                for k, (s, n) in enumerate(cut_points(len(ids), capacity)):
                    row.append(i), piece.append(k), start.append(s), length.append(n)
                    crc.append(zlib.crc32(ids[s : s + n].tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int32())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return cut


def pack(lengths: np.ndarray, capacity: int, max_docs: int, max_cost: int, rule: str = "norm", weights: tuple[float, float, float] = (1.0, 0.01, 0.01)) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each piece. ``lengths`` must each fit an empty bin."""
    n = len(lengths)
    where, offset = np.empty(n, np.int64), np.empty(n, np.int64)
    limits = np.array([capacity, max_docs, max_cost], np.float64)
    weight = np.array(weights, np.float64) / limits**2
    room, names, used, live, made = np.empty((max(n, 1), 3)), np.empty(max(n, 1), np.int64), np.zeros(max(n, 1), np.int64), 0, 0
    smallest = int(lengths.min()) if n else 0
    for i in np.argsort(-lengths, kind="stable"):
        need = np.array([lengths[i], 1.0, float(lengths[i]) ** 2])
        best = -1
        if live:
            left = room[:live] - need
            fits = (left >= 0).all(1)
            if fits.any():
                score = (left * left) @ weight if rule == "norm" else -((room[:live] * need) @ weight)
                score[~fits] = np.inf
                best = int(score.argmin())
        if best < 0:
            if (need > limits).any():
                raise ValueError("a piece exceeds a capacity by itself")
            best, live = live, live + 1
            room[best], names[best] = limits, made
            made += 1
        where[i], offset[i] = names[best], used[names[best]]
        used[names[best]] += lengths[i]
        room[best] -= need
        if room[best, 0] < smallest or room[best, 1] < 1:  # no other piece can fit
            live -= 1
            room[best], names[best] = room[live], names[live]
    return where, offset


def _packer(capacity: int, max_docs: int, max_cost: int, rule: str):
    @tidy
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (group,), run in runs(batches, 1):
            by = run.sort_by([("doc_id", "ascending"), ("start", "ascending")])
            where, offset = pack(by.column("length").to_numpy(), capacity, max_docs, max_cost, rule)
            out = by.drop_columns(["grp"]).append_column("sequence_id", pa.array((group << 32) + where)).append_column("offset", pa.array(offset))
            yield from out.combine_chunks().to_batches()

    return place


def packed(docs: DataFrame, capacity: int = CAPACITY, max_docs: int | None = None, max_cost: int | None = None, rule: str = "norm", vocabulary: str | None = None, json_vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for each piece; see the module's text."""
    max_docs, max_cost = max_docs or capacity, max_cost or capacity**2
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, piece int, start bigint, length bigint, ids_crc32 bigint"
    pieces = written(slim.mapInArrow(_cutter(capacity, vocabulary, json_vocabulary), schema), "pieces")
    groups = max(1, -(-pieces.count() // GROUP))
    # the row number keeps an id that repeats from filling one group
    dealt = pieces.select(F.pmod(F.xxhash64("doc_id", "start", F.monotonically_increasing_id()), F.lit(groups)).alias("grp"), "*")
    return dealt.repartition(min(groups, PARTITIONS), "grp").sortWithinPartitions("grp").mapInArrow(_packer(capacity, max_docs, max_cost, rule), f"{schema}, sequence_id bigint, offset bigint")

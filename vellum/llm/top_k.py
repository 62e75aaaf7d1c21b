"""Exact top-k search by inner product: branch and bound over dimension blocks in vertical layout.

Vectors become integers, floor(scale * x). First every query is held against a small sample of the candidates: the k-th best
score there is a bound that its results cannot fall below. Then candidates and queries are dealt into blocks, and a task
gets one block of each. Candidates lie dimension by dimension. Inner products are summed over one block of dimensions at
a time; what the remaining dimensions can still add lies within plus or minus the product of the remaining norms
(Cauchy-Schwarz). A candidate whose best case is below the query's bound, or below the k-th best worst case of its block, is
dropped, and the survivors are compacted before the next block of dimensions. No candidate that could be a result, or tie with
one, is ever dropped; the sample decides how soon candidates go, never which results come.

Scale: the work is queries times candidates by nature. Both sides are cut into blocks of bounded size, so tasks have equal size. A
row is sent once to each block of the other side: with blocks of ``CANDIDATES`` and ``QUERIES`` rows the shuffle has a few
ten-thousandths of the pairs that are compared. Blocks are dealt over a bounded number of partitions, each sends at most k
rows a query, and bounds make most blocks send far fewer. Rows are dealt by id and vector, and of rows equal in both k go on, since more
cannot be among k results; so neither an id nor a row that repeats without end fills a block.

Defined cases: null vectors, and those with null, NaN or infinite components, take no part; vectors of unequal length are
taken as if zeros followed; a row is no candidate of queries with its own id; rows that repeat an id are candidates each, and
query rows of one id share one list of k; a null id takes no part; with fewer candidates than k all are returned; ties go to the
smaller id; scores past 64 bits stop at its limits; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vellum.llm._arrow import runs, tidy

CANDIDATES, QUERIES, STEP, TOGETHER = 32_768, 8_192, 16, 64
#: Rows of the sample that gives the queries' first bounds; blocks of candidates that even a small table is dealt into; the most partitions.
SAMPLE, SPREAD, PARTITIONS = 4_096, 16, 8_192


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(id, q): integer vectors of the rows that take part."""
    fine = F.forall(vector_col, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)) & ~F.isnan(F.coalesce(x, F.lit(0.0))))
    kept = vectors.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & fine)
    q = F.transform(vector_col, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("bigint"))
    return kept.select(F.col(id_col).cast("bigint").alias("id"), q.alias("q"))


def _matrix(lists: pa.ListArray, width: int) -> np.ndarray:
    """The lists as rows of a matrix, zeros behind the shorter ones."""
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), width))
    out[np.arange(width)[None, :] < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _width(lists: pa.ListArray) -> int:
    return int(np.diff(lists.offsets.to_numpy()).max(initial=0))


def _exact(*sides: np.ndarray) -> bool:
    """Whether floating point sums of these integers' products are exact."""
    return float(np.prod([np.abs(x).max(initial=0) for x in sides])) * max(sides[0].shape[1], 1) < 2**52


def _bounder(sample, k: int):
    """Adds to each query (id, q) the k-th best score over the sample, minus infinity where it has fewer."""

    @tidy
    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, lists = sample.value
        for batch in batches:
            width = max(_width(batch.column(1)), _width(lists))
            own, others = _matrix(batch.column(1), width), _matrix(lists, width)
            least = np.full(batch.num_rows, -np.inf)
            if _exact(own, others) and len(ids) > k:
                for at in range(0, len(own), 256):
                    scores = own[at : at + 256] @ others.T
                    scores[batch.column(0).to_numpy()[at : at + 256, None] == ids[None, :]] = -np.inf
                    least[at : at + 256] = np.partition(scores, len(ids) - k, axis=1)[:, len(ids) - k]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(least)], ["id", "q", "least"])

    return bound


def best_of_block(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int, least: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """(query number, candidate numbers) of at least all of the k best of the block that reach ``least``, ties included."""
    least = np.full(len(queries), -np.inf) if least is None else least
    n, width = vectors.shape
    by = np.argsort(-vectors.var(0), kind="stable") if n else np.arange(width)  # the dimensions that tell most come first
    tall, queries = np.ascontiguousarray(vectors[:, by].T), queries[:, by]
    edges = [*range(0, width, STEP), width]
    rest = [np.sqrt((tall[a:] ** 2).sum(0)) for a in edges[1:]]
    mine = [np.sqrt((queries[:, a:] ** 2).sum(1)) for a in edges[1:]]
    for at in range(0, len(queries), TOGETHER):
        some = queries[at : at + TOGETHER]
        whole = min(2, len(edges) - 1)  # the first blocks of dimensions for several queries at once, when nothing can be dropped yet
        sums = some[:, : edges[whole]] @ tall[: edges[whole]]
        for r in range(len(some)):
            live, part = np.arange(n), sums[r]
            own = ids == query_ids[at + r]
            if own.any():
                live, part = live[~own], part[~own]
            for j in range(whole, len(edges)):
                if not len(live) or (len(live) <= k and np.isneginf(least[at + r])):
                    break
                slack = rest[j - 1][live] * mine[j - 1][at + r] * (1 + 1e-9) + 1e-6
                worst = part - slack
                best = part + slack
                floor = least[at + r] if len(live) <= k else max(least[at + r], np.partition(worst, len(worst) - k)[len(worst) - k])
                stay = best >= floor
                live, part = live[stay], part[stay]
                if j < len(edges) - 1:
                    part = part + some[r, edges[j] : edges[j + 1]] @ tall[edges[j] : edges[j + 1], live]
            yield at + r, live


def _scores(query: list[int], vectors: list[list[int]]) -> list[int]:
    limit = 2**63
    return [max(-limit, min(limit - 1, sum(a * b for a, b in zip(query, v, strict=False)))) for v in vectors]


def _searcher(k: int):
    @tidy
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, run in runs(batches, 2):
            run = run.combine_chunks()
            side, ids, lists = run.column("side").to_numpy(), run.column("id").to_numpy(), run.column("q").chunk(0)
            qs, cs = np.flatnonzero(side == 1), np.flatnonzero(side == 0)
            if not len(qs) or not len(cs):
                continue
            matrix, least = _matrix(lists, _width(lists)), run.column("least").to_numpy()
            asked, there = matrix[qs], matrix[cs]
            exact, out = _exact(asked, there), [[], [], []]
            for qi, live in best_of_block(asked, ids[qs], there, ids[cs], k, least[qs]):
                own = cs[live]
                scores = (there[live] @ asked[qi]).astype(np.int64) if exact else np.array(_scores(lists[int(qs[qi])].as_py(), [lists[int(c)].as_py() for c in own]), np.int64)
                first = np.lexsort((ids[own], -scores.astype(object) if not exact else -scores))[:k]
                out[0].append(np.full(len(first), ids[qs[qi]], np.int64)), out[1].append(ids[own][first]), out[2].append(scores[first])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in out], ["query_id", "vec_id", "score"])

    return search


def top_k(vectors: DataFrame, queries: F.Column, k: int = 20, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding", block: int = CANDIDATES, sample: int = SAMPLE) -> DataFrame:
    """(query_id, rank, vec_id, score). ``queries`` is a condition on the column ``id`` that marks the query rows."""
    spark, rows = vectors.sparkSession, quantised(vectors, id_col, vector_col, scale)
    n, n_queries = rows.agg(F.count("*"), F.count_if(queries)).first()
    some = rows.filter(F.pmod(F.xxhash64("id"), F.lit(max(1, n // sample))) == 0).limit(2 * sample).toArrow()
    lists = some.column("q").combine_chunks()
    held = spark.sparkContext.broadcast((some.column("id").to_numpy(), lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists))
    c_blocks = max(1, -(-n // block), min(SPREAD, n // 2_048))
    q_blocks = max(1, -(-n_queries // min(block, QUERIES)))
    deal = lambda m: F.pmod(F.xxhash64("id", "q"), F.lit(m)).cast("int")
    copies = rows.groupBy("id", "q").agg(F.count("*").alias("n"))
    rows = copies.select("id", "q", F.explode(F.sequence(F.lit(1), F.least("n", F.lit(k)))).alias("copy")).select("id", "q")
    candidates = rows.select(deal(c_blocks).alias("c"), F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))).alias("b"), F.lit(0).alias("side"), "id", "q", F.lit(0.0).alias("least"))
    bounded = rows.filter(queries).mapInArrow(_bounder(held, k), "id bigint, q array<bigint>, least double")
    asked = bounded.select(F.explode(F.sequence(F.lit(0), F.lit(c_blocks - 1))).alias("c"), deal(q_blocks).alias("b"), F.lit(1).alias("side"), "id", "q", "least")
    parts = candidates.union(asked).repartition(min(c_blocks * q_blocks, PARTITIONS), "c", "b").sortWithinPartitions("c", "b")
    best = parts.mapInArrow(_searcher(k), "query_id bigint, vec_id bigint, score bigint")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

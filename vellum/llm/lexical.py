"""Ranked lexical search: a hybrid of term-at-a-time and document-at-a-time evaluation over BM25-like integer scores.

Documents are read once for the terms that the queries use: each gives its length and the places of its list of such terms. From
this table come the statistics and, in every task, the inverted lists of a segment of documents in order of their ids. For each query
the short lists are evaluated term by term into summed accumulators. These then act as one iterator whose bound is its largest sum,
beside the long lists with theirs. Documents are passed window by window in order of id: a window whose bounds cannot reach the
k-th best score is skipped; else the lists that alone cannot reach it are left aside, candidates come from the others, and the lists
left aside are only looked up at candidates, the strongest first, while their bound still reaches.

Scores are exact: partial sums are integers, a document is dropped only when a bound shows that it cannot be among the k best, and
documents that could tie are kept until the end.

Scale: queries go in blocks of ``BLOCK`` bytes, whose terms are broadcast; the driver holds one block's queries and its
terms' weights. Documents are scored where their postings lie: a task sends at most k documents a query, and only those that reach the k-th
best of a sample of ``SAMPLE`` documents (the sample decides how many are sent, never which ones come). A segment has at most
``SEGMENT`` postings. Each block of queries reads the texts once; the postings are written to the shared folder.

Defined cases: a null or empty text has no terms, counts in no statistic and is in no result; a query without terms, or whose terms no
document has, gives no rows; rows that repeat a query (equal id and text) count once, queries that share an id but not a text are ranked
each; a document that repeats is ranked each time; ties go to the smaller id, null ids last; long texts are read whole; other columns are
ignored; empty tables give an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vellum.llm._arrow import tidy
from vellum.llm._shared import written

#: Terms in UTF-8: every byte beyond ASCII belongs to one.
TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: Bytes of queries in a block, postings of a segment, documents of a window and of the sample; a list is long if it has more than this share of the segment's documents.
BLOCK, SEGMENT, WINDOW, SAMPLE, LONG = 4 << 20, 4_000_000, 2_048, 20_000, 1 / 64
ID_LAST = np.iinfo(np.int64).max


def terms(text: bytes | None) -> list[bytes]:
    return TERM.findall((text or b"").translate(_LOWER))


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _poster(known):
    """(id, n, terms, tfs) of each text: its length in terms, and its terms among the queries' with their counts."""

    @tidy
    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = known.value
        for batch in batches:
            sizes, where, numbers, counts = [], [0], [], []
            for text in batch.column(1):
                found = terms(memoryview(text.as_buffer()).tobytes() if text.is_valid else b"")
                own = Counter(found)
                mine = [(number[t], own[t]) for t in (own.keys() & number.keys())]
                sizes.append(len(found))
                where.append(where[-1] + len(mine))
                numbers += [x for x, _ in mine]
                counts += [x for _, x in mine]
            lists = [pa.ListArray.from_arrays(pa.array(where, pa.int32()), pa.array(x, t)) for x, t in ((numbers, pa.int32()), (counts, pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), *lists], ["id", "n", "terms", "tfs"])

    return post


class Segment:
    """Inverted lists of some documents, in order of their ids, with each posting's share of the score."""

    def __init__(self, ids: np.ndarray, n: np.ndarray, where: np.ndarray, term: np.ndarray, tf: np.ndarray, stats: tuple[int, int, dict[int, int]], window: int = WINDOW):
        n_docs, n_terms, weights = stats
        order = np.argsort(ids, kind="stable")
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        self.ids, doc = ids[order], np.repeat(place, where)
        m = 75 + np.array([25 * int(x) * n_docs // n_terms for x in n], np.int64)[np.repeat(np.arange(len(ids)), where)]
        share = 1_000_000_000 * tf // (1000 * tf + 12 * m)
        by = np.lexsort((doc, term))
        self.doc, term = doc[by], term[by]
        self.share = share[by] * np.array([weights[t] for t in np.unique(term)], np.int64)[np.unique(term, return_inverse=True)[1]] if len(term) else share
        starts = np.flatnonzero(np.concatenate(([True], term[1:] != term[:-1]))) if len(term) else np.empty(0, np.int64)
        self.lists = dict(zip(term[starts].tolist(), zip(starts.tolist(), [*starts[1:].tolist(), len(term)], strict=True), strict=True))
        self.edges = np.arange(0, len(ids) + window, window)
        self._tops: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def tops(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        """A long list's first place in each window, and its largest share there."""
        if term not in self._tops:
            a, b = self.lists[term]
            at = np.searchsorted(self.doc[a:b], self.edges)
            full = at[1:] > at[:-1]
            top = np.zeros(len(self.edges) - 1, np.int64)
            top[full] = np.maximum.reduceat(self.share[a:b], at[:-1][full])
            self._tops[term] = (at + a, top)
        return self._tops[term]

    def search(self, query: list[tuple[int, int]], k: int, best: tuple[np.ndarray, np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best (scores, ids) of ``best`` and these documents. ``query``: (term, times); no result has a score below ``least``."""
        have = sorted((self.lists[t][1] - self.lists[t][0], t, times) for t, times in query if t in self.lists)
        short = [(t, times) for size, t, times in have if size <= LONG * len(self.ids)]
        long = [(t, times) for size, t, times in have if size > LONG * len(self.ids)]
        docs, sums = self.accumulated(short)
        floor = max(least, int(best[0][-1]) if len(best[0]) == k else 1, int(np.partition(sums, len(sums) - k)[len(sums) - k]) if len(sums) >= k else 1)
        tops = [self.tops(t)[1] * times for t, times in long]
        at = np.searchsorted(docs, self.edges)
        own = np.zeros(len(self.edges) - 1, np.int64)
        full = at[1:] > at[:-1]
        if full.any():
            own[full] = np.maximum.reduceat(sums, at[:-1][full])
        tips = np.maximum.reduce([own, *tops])  # each window has a document that scores so much at least
        if len(tips) >= k:
            floor = max(floor, int(np.partition(tips, len(tips) - k)[len(tips) - k]))
        bounds = own + sum(tops, np.zeros(len(own), np.int64))
        for w in np.flatnonzero(bounds >= floor):
            if bounds[w] < floor:  # the k-th best rose meanwhile
                continue
            found = self.window(w, docs[at[w] : at[w + 1]], sums[at[w] : at[w + 1]], [(int(top[w]), t, times) for top, (t, times) in zip(tops, long, strict=True)], floor)
            if len(found[0]):
                scores, ids = np.concatenate((best[0], found[0])), np.concatenate((best[1], found[1]))
                order = np.lexsort((ids, -scores))[:k]
                best = scores[order], ids[order]
                if len(order) == k:
                    floor = max(floor, int(best[0][-1]))
        return best

    def accumulated(self, short: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
        """Documents of the short lists with their sums."""
        if not short:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        docs = np.concatenate([self.doc[slice(*self.lists[t])] for t, _ in short])
        values = np.concatenate([self.share[slice(*self.lists[t])] * times for t, times in short])
        order = np.argsort(docs, kind="stable")
        docs, values = docs[order], values[order]
        starts = np.flatnonzero(np.concatenate(([True], docs[1:] != docs[:-1])))
        return docs[starts], np.add.reduceat(values, starts)

    def window(self, w: int, docs: np.ndarray, sums: np.ndarray, long: list[tuple[int, int, int]], floor: int) -> tuple[np.ndarray, np.ndarray]:
        """(scores, ids) of a window's documents that reach ``floor``."""
        first = int(self.edges[w])
        total = np.zeros(min(int(self.edges[w + 1]), len(self.ids)) - first, np.int64)
        seen = np.zeros(len(total), bool)
        total[docs - first], seen[docs - first] = sums, True
        long = sorted(x for x in long if x[0] > 0)
        aside = 0  # so many of the weakest lists cannot reach the floor together
        while aside < len(long) and sum(x[0] for x in long[: aside + 1]) < floor:
            aside += 1
        for _, t, times in long[aside:]:
            at = self.tops(t)[0]
            here = self.doc[at[w] : at[w + 1]] - first
            total[here] += self.share[at[w] : at[w + 1]] * times
            seen[here] = True
        live = np.flatnonzero(seen)
        rest = sum(x[0] for x in long[:aside])
        for top, t, times in reversed(long[:aside]):
            live = live[total[live] + rest >= floor]
            if not len(live):
                break
            at = self.tops(t)[0]
            here = self.doc[at[w] : at[w + 1]] - first
            place = np.minimum(np.searchsorted(here, live), len(here) - 1)
            hit = here[place] == live
            total[live[hit]] += self.share[at[w] : at[w + 1]][place[hit]] * times
            rest -= top
        live = live[total[live] >= floor]
        return total[live], self.ids[first + live]


def _searcher(held, k: int, segment: int, window: int):
    @tidy
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, stats, least = held.value
        best = [(np.empty(0, np.int64), np.empty(0, np.int64))] * len(items)

        def passed(rows: pa.Table) -> None:
            rows = rows.combine_chunks()
            lists = [rows.column(c).combine_chunks() for c in ("terms", "tfs")]
            lists = [x.chunk(0) if isinstance(x, pa.ChunkedArray) else x for x in lists]
            ids = rows.column("id").fill_null(ID_LAST).to_numpy()
            where = np.diff(lists[0].offsets.to_numpy())
            part = Segment(ids, rows.column("n").to_numpy(), where, lists[0].flatten().to_numpy().astype(np.int64), lists[1].flatten().to_numpy(), stats, window)
            for i, (_, query) in enumerate(items):
                best[i] = part.search(query, k, best[i], least.get(i, 1))

        some, size = [], 0
        for batch in batches:
            some.append(batch)
            size += len(batch.column(2).flatten())
            if size >= segment:
                passed(pa.Table.from_batches(some))
                some, size = [], 0
        if sum(b.num_rows for b in some):
            passed(pa.Table.from_batches(some))
        sizes = [len(scores) for scores, _ in best]
        ids = np.concatenate([np.empty(0, np.int64), *(x for _, x in best)])
        columns = [
            pa.array(np.repeat(np.arange(len(items)), sizes), pa.int32()), pa.array(np.repeat([i for i, _ in items], sizes).tolist() if items else [], pa.int64()),
            pa.array(ids, pa.int64(), mask=ids == ID_LAST), pa.array(np.concatenate([np.empty(0, np.int64), *(x for x, _ in best)]), pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["item", "item_id", "doc_id", "score"])

    return search


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _block(docs: DataFrame, asked: list, k: int, segment: int, window: int, sample: int) -> DataFrame:
    """Results of some queries (item_id, Counter of terms)."""
    spark = docs.sparkSession
    number = {t: i for i, t in enumerate(sorted(set().union(*(q for _, q in asked))))}
    known = spark.sparkContext.broadcast(number)
    postings = written(docs.mapInArrow(_poster(known), "id bigint, n bigint, terms array<int>, tfs array<bigint>"), "postings")
    n_docs, n_terms = postings.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    dfs = postings.select(F.explode("terms").alias("t")).groupBy("t").count().collect()  # one row a term of these queries
    stats = n_docs, n_terms, {r["t"]: weight(n_docs, r["count"]) for r in dfs}
    items = [(i, [(number[t], times) for t, times in q.items()]) for i, q in asked]
    schema, useful = "item int, item_id bigint, doc_id bigint, score bigint", postings.filter(F.size("terms") > 0)
    least = {}
    if n_docs > 4 * sample:
        some = useful.filter(F.pmod(F.xxhash64("id"), F.lit(max(1, n_docs // sample))) == 0).limit(2 * sample)
        held = spark.sparkContext.broadcast((items, stats, {}))
        found = _ranked(some.mapInArrow(_searcher(held, k, segment, window), schema), k).filter(F.col("rank") == k)
        least = {r["item"]: r["score"] for r in found.select("item", "score").collect()}  # one row a query of the block
    held = spark.sparkContext.broadcast((items, stats, least))
    return _ranked(useful.mapInArrow(_searcher(held, k, segment, window), schema), k).select("item_id", "rank", "doc_id", "score")


def ranked_search(
    docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", query_col: str = "text",
    block: int = BLOCK, segment: int = SEGMENT, window: int = WINDOW, sample: int = SAMPLE,
) -> DataFrame:
    """(item_id, rank, doc_id, score): for each query its k best documents of a score above 0."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("binary").alias("text"))
    asked = written(items.select(F.col(item_col).cast("bigint").alias("item_id"), F.col(query_col).cast("binary").alias("text")).filter("text is not null").distinct(), "queries")
    size = asked.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    blocks, out = -(-size // block), None
    for b in range(blocks):
        rows = asked.filter(F.pmod(F.xxhash64("text", "item_id"), F.lit(blocks)) == b).collect()  # about ``block`` bytes
        own = [(r.item_id, q) for r in sorted(rows, key=lambda r: (r.item_id is None, r.item_id, r.text)) if (q := Counter(terms(bytes(r.text))))]
        if own:
            part = _block(texts, own, k, segment, window, sample)
            part = part if blocks == 1 else written(part, "ranked")
            out = part if out is None else out.union(part)
    return spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint") if out is None else out

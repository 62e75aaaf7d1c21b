"""MinHash near-duplicates through an LSH forest, with every link confirmed on full shingle sets.

1. One pass over the texts: per document the number of distinct shingles, a 128-bit fingerprint of the set, the forest's
   ``ORDERS`` prefix keys (each of ``DEPTH`` minimum hashes), and a sketch of ``BINS`` bytes that samples the set by one
   permutation. Documents with equal sets form a class; only classes go on.
2. Forest: ``ORDERS`` signature orders. Classes with the same prefix in an order form a region. Inside a region the classes are
   sorted by their sketches in that order. Neighbours, which share the longest prefixes, are compared first and joined
   if they are alike. The depth adapts to the region: a run of joined neighbours is as deep as its members agree and needs no
   comparison inside, a class that no neighbour is like is held against the whole region at its shallow prefix. Deeper
   prefixes never part a region, so depth cannot lose a pair. Regions of more than ``REGION`` classes are dealt into blocks
   by a hash of the class, and every two blocks are compared in a task of their own.
3. Sketches decide candidates within ``SLACK`` standard deviations below the threshold, which keeps texts that only share a
   template apart, so candidate components stay close to the true ones. A component's full sets are sent to its task once;
   there an inverted index of shingles counts exact intersections, and exact links make the result's components.
   Components of more than ``REGION`` classes or ``SET_BYTES`` bytes are compared block by block in separate tasks.

Scale: only keys and numbers are shuffled to find regions; sketches follow to regions of two classes or more, texts and full
sets only to candidate components. Exact copies collapse in an aggregation with partial sums; a task never gets more than about
two blocks. No partner or candidate is capped: a region of n blocks takes n(n+1)/2 tasks, so its work is quadratic in its
different classes.

Defined cases: a null or empty text and one of white space only has n_shingles 0 and is linked with nothing; very long texts are
sketched and compared whole; ties (equal prefixes, equal sketches) are all compared; repeated rows with equal ids are kept as rows
and share a class if their texts agree; rows with a null id are linked like others and never lend a component their
id while it has another; other columns of the input are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vellum.llm._arrow import runs, tidy
from vellum.llm._shared import broadcast_if_small, components, drop_written, written
from vellum.llm._text import blocks, mix64, shingle_hashes, span_hashes, word_spans

ORDERS, DEPTH, BINS = 16, 4, 256
#: Classes, and bytes of their sets, in a block.
REGION, SET_BYTES = 4096, 64 << 20
#: Standard deviations that a candidate's sketch may stay below the threshold, and bins that two shingles may share.
SLACK, SHARED = 3.5, 1.5
EDGE = np.arange(BINS, dtype=np.uint64) << np.uint64(64 - 8)


def _mults() -> np.ndarray:
    return mix64(np.arange(ORDERS * DEPTH, dtype=np.uint64) + np.uint64(77)) | np.uint64(1)


def prefix_keys(shingles: np.ndarray, mults: np.ndarray) -> np.ndarray:
    """For each order a 64-bit key of its first DEPTH minimum hashes."""
    least = np.full(ORDERS * DEPTH, 0xFFFF_FFFF_FFFF_FFFF, np.uint64)
    for at in range(0, len(shingles), 4096):
        least = np.minimum(least, (shingles[at : at + 4096, None] * mults[None, :]).min(0))
    values = mix64(least).reshape(ORDERS, DEPTH) * mults[:DEPTH]
    return mix64(values.sum(1, dtype=np.uint64) + np.arange(ORDERS, dtype=np.uint64)).view(np.int64)


def sketch(shingles: np.ndarray) -> np.ndarray:
    """One permutation: a byte of the smallest hash in each of BINS ranges of the sorted hashes, 0 for an empty one."""
    at = np.searchsorted(shingles, EDGE)
    inside = at < len(shingles)
    low = shingles[np.minimum(at, len(shingles) - 1)]
    inside &= (low >> np.uint64(56)) == (EDGE >> np.uint64(56))
    return np.where(inside, (low & np.uint64(0xFF)) % np.uint64(255) + np.uint64(1), 0).astype(np.uint8)


def fingerprint(shingles: np.ndarray) -> bytes:
    """128 bits that depend on the set alone."""
    return np.array([mix64(shingles).sum(dtype=np.uint64), mix64(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64) ^ np.uint64(len(shingles))], np.uint64).tobytes()


def alike(some: np.ndarray, sizes: np.ndarray, one: np.ndarray, size: int, threshold: float) -> np.ndarray:
    """Which sketches may be of sets that overlap ``one`` by the threshold; sizes that rule it out decide exactly."""
    agree = ((some == one) & (one != 0)).sum(1)
    either = ((some != 0) | (one != 0)).sum(1)
    union = (sizes + size) / (1 + threshold)  # of two sets that just reach the threshold
    spread = np.sqrt(threshold * (1 - threshold) * either * np.maximum(1 - either / np.maximum(union, 1), 0))
    close = np.minimum(sizes, size) >= threshold * np.maximum(sizes, size) * (1 - 1e-9)
    return close & (agree >= threshold * either - SLACK * spread - SHARED)


def _sketcher(width: int):
    @tidy
    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mults = _mults()
        for batch in batches:
            sizes, prints, keys, bins = [], [], [], []
            for _, data in blocks(x.as_py() for x in batch.column(2)):
                buf, starts, ends, first = word_spans(data)
                for own in shingle_hashes(span_hashes(buf, starts, ends), first, width):
                    some = len(own) > 0
                    sizes.append(len(own))
                    prints.append(fingerprint(own) if some else None)
                    keys.append(prefix_keys(own, mults) if some else None)
                    bins.append(sketch(own).tobytes() if some else None)
            columns = [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()), pa.array(keys, pa.list_(pa.int64())), pa.array(bins, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "th", "n_shingles", "fp", "keys", "bins"])

    return sketched


def _set_maker(width: int):
    """Full sets of the texts (text, fp, cid, root, n_blocks) whose set has the fingerprint, once a class in each task."""

    @tidy
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            wanted, cids = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            keep, sets, k = [], [], 0
            for _, data in blocks(x.as_py() for x in batch.column(0)):
                buf, starts, ends, first = word_spans(data)
                for own in shingle_hashes(span_hashes(buf, starts, ends), first, width):
                    if cids[k] not in seen and len(own) and fingerprint(own) == wanted[k]:
                        seen.add(cids[k])
                        keep.append(k), sets.append(own.tobytes())
                    k += 1
            who = pa.array(keep, pa.int32())
            yield pa.RecordBatch.from_arrays([*(batch.column(i).take(who) for i in (2, 3, 4)), pa.array(sets, pa.binary())], ["cid", "root", "n_blocks", "shingles"])

    return made


def merge(label: np.ndarray, i: int, others: np.ndarray) -> None:
    """Puts the components of ``others`` into that of i. ``label`` holds a component number for each member."""
    if len(others):
        label[np.isin(label, label[others])] = label[i]


def star(label: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(member, least member of its component) of every member that is not the least: the flattest trees there are."""
    by = np.argsort(names, kind="stable")
    _, first, inverse = np.unique(label[by], return_index=True, return_inverse=True)
    root = names[by][first[inverse]]
    rest = names[by] != root
    return names[by][rest], root[rest]


def _edges(left: list[np.ndarray], right: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.empty(0, np.int64), *x]), pa.int64()) for x in (left, right)], ["a", "b"])


def region_labels(bins: np.ndarray, sizes: np.ndarray, sides: np.ndarray, cross: bool, threshold: float) -> np.ndarray:
    """Component numbers of the sorted sketches of a region. With ``cross`` only pairs of different sides are compared."""
    label = np.arange(len(bins))
    for i in range(len(bins) - 1):  # neighbours first,
        if not cross or sides[i] != sides[i + 1]:
            if alike(bins[i + 1 : i + 2], sizes[i + 1 : i + 2], bins[i], sizes[i], threshold)[0]:
                label[i + 1] = label[i]
    for i in range(len(bins) - 1):  # then whatever they have not joined
        other = label[i + 1 :] != label[i]
        if cross:  # pairs of one block have their own task
            other &= sides[i + 1 :] != sides[i]
        rest = np.flatnonzero(other) + i + 1
        for at in range(0, len(rest), 1024):
            some = rest[at : at + 1024]
            merge(label, i, some[alike(bins[some], sizes[some], bins[i], sizes[i], threshold)])
    return label


def _forest(threshold: float):
    @tidy
    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right, held = [], [], 0
        for (_, i, j), run in runs(batches, 3):
            run = run.combine_chunks()
            tree, sides, cids, sizes = run.column("tree")[0].as_py(), *(run.column(c).to_numpy() for c in ("block", "cid", "n"))
            bins = np.frombuffer(b"".join(run.column("bins").to_pylist()), np.uint8).reshape(-1, BINS)
            turned = np.roll(bins, -tree * (BINS // ORDERS), axis=1)  # the order of this tree: neighbours share the longest prefixes
            by = np.argsort(np.ascontiguousarray(turned).view(f"S{BINS}").ravel(), kind="stable")
            a, b = star(region_labels(bins[by], sizes[by], sides[by], i != j, threshold), cids[by])
            left.append(a), right.append(b)
            held += len(a)
            if held >= 100_000:
                yield _edges(left, right)
                left, right, held = [], [], 0
        yield _edges(left, right)

    return candidates


def exact_links(sets: list[np.ndarray], sides: np.ndarray, cross: bool, percent: int) -> np.ndarray:
    """Component numbers of sets, linked where two overlap by ``percent`` or more; an inverted index counts.

    With ``cross`` only pairs of different sides are compared.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    values = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    by = np.argsort(values, kind="stable")
    values, owner = values[by], owner[by]
    edge = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else np.empty(0, np.int64)
    rank = np.empty(len(by), np.int64)
    rank[by] = np.cumsum(np.concatenate(([True], values[1:] != values[:-1]))) - 1 if len(values) else 0
    stop = np.append(edge[1:], len(values))
    at = np.concatenate(([0], np.cumsum(sizes)))
    label = np.arange(len(sets))
    for i in range(len(sets) - 1):
        if not cross and (label == label[i]).all():
            break
        own = rank[at[i] : at[i + 1]]
        lens = stop[own] - edge[own]
        total = int(lens.sum())
        spots = np.repeat(edge[own] - np.concatenate(([0], np.cumsum(lens)[:-1])), lens) + np.arange(total)
        shared = np.bincount(owner[spots], minlength=len(sets))
        good = 100 * shared >= percent * (sizes + sizes[i] - shared)
        good[: i + 1] = False
        if cross:
            good &= sides != sides[i]
        merge(label, i, np.flatnonzero(good & (label != label[i])))
    return label


def _verifier(percent: int):
    @tidy
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = [], []
        for (_, i, j), run in runs(batches, 3):
            cids, first = np.unique(run.column("cid").to_numpy(), return_index=True)  # a class that repeated rows sent twice counts once
            sides, held = run.column("block").to_numpy()[first], run.column("shingles").to_pylist()
            a, b = star(exact_links([np.frombuffer(held[k], np.uint64) for k in first], sides, i != j, percent), cids)
            left.append(a), right.append(b)
        yield _edges(left, right)

    return verify


def _pairs(n_blocks: F.Column, block: F.Column) -> F.Column:
    """The (i, j) tasks of a row of a block, i <= j: one with each block."""
    return F.transform(F.sequence(F.lit(0), n_blocks - 1), lambda x: F.struct(F.least(x, block).alias("i"), F.greatest(x, block).alias("j")))


def candidate_edges(classes: DataFrame, threshold: float, region: int = REGION) -> DataFrame:
    """(a, b): stars of the candidates in all regions of all trees. ``classes`` has cid, n_shingles, keys and bins."""
    keys = classes.select("cid", F.posexplode("keys").alias("tree", "key")).select("key", "tree", "cid")
    counts = keys.groupBy("key").agg(F.count("*").alias("n_in")).filter("n_in > 1")
    n_blocks = F.ceil(F.col("n_in") / F.lit(region)).cast("int")
    held = keys.join(counts, "key").withColumn("block", F.pmod(F.xxhash64("cid"), n_blocks).cast("int"))
    dealt = held.select("key", F.explode(_pairs(n_blocks, F.col("block"))).alias("pair"), "tree", "block", "cid").select("key", "pair.i", "pair.j", "tree", "block", "cid")
    tasks = dealt.join(classes.select("cid", F.col("n_shingles").alias("n"), "bins"), "cid").select("key", "i", "j", "tree", "block", "cid", "n", "bins")
    return tasks.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(_forest(threshold), "a bigint, b bigint").distinct()


def _resolved(docs: DataFrame, width: int, percent: int, id_col: str, text_col: str, region: int, set_bytes: int) -> DataFrame:
    """(doc_id, th, n_shingles, component_id, chosen): th is a hash of the text; the rows chosen are those of one id and text of each component."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
    id_type = slim.schema["doc_id"].dataType.simpleString()
    sketches = written(slim.mapInArrow(_sketcher(width), f"doc_id {id_type}, th bigint, n_shingles bigint, fp binary, keys array<bigint>, bins binary"), "sketches")
    named = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "th")
    grouped = sketches.filter("n_shingles > 0").groupBy("fp").agg(F.min(named).alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("keys").alias("keys"), F.first("bins").alias("bins"))
    classes = written(grouped.withColumn("cid", F.monotonically_increasing_id()), "classes")
    groups = written(components(candidate_edges(classes, percent / 100, region)), "groups")
    of = groups.join(classes.select("cid", "n_shingles", "fp", "rep"), F.col("node") == F.col("cid"))
    totals = groups.join(classes.select("cid", "n_shingles"), F.col("node") == F.col("cid")).groupBy("root").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("s"))
    n_blocks = F.ceil(F.greatest(F.col("n") / F.lit(region), 8 * F.col("s") / F.lit(set_bytes))).cast("int")
    sized = totals.select("root", n_blocks.alias("n_blocks"))
    wanted = written(of.join(sized, "root").select(F.col("rep.doc_id").alias("w_id"), F.col("rep.th").alias("w_th"), "fp", "cid", "root", "n_blocks"), "wanted")
    here = slim.join(broadcast_if_small(wanted), F.col("doc_id").eqNullSafe(F.col("w_id")) & (F.col("th") == F.col("w_th")))
    sets = here.select("text", "fp", "cid", "root", "n_blocks").mapInArrow(_set_maker(width), "cid bigint, root bigint, n_blocks int, shingles binary")
    dealt = sets.withColumn("block", F.pmod(F.xxhash64("cid"), "n_blocks").cast("int"))
    dealt = dealt.select("root", "cid", "shingles", "block", F.explode(_pairs(F.col("n_blocks"), F.col("block"))).alias("pair")).select("root", "pair.i", "pair.j", "block", "cid", "shingles")
    links = dealt.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j").mapInArrow(_verifier(percent), "a bigint, b bigint")
    roots = written(components(links), "roots")
    drop_written(groups), drop_written(wanted)
    linked = classes.join(roots, classes.cid == roots.node, "left").select("fp", "rep", F.coalesce("root", "cid").alias("root"))
    least = linked.groupBy("root").agg(F.min("rep").alias("first"))
    out = sketches.select("doc_id", "th", "n_shingles", "fp").join(linked.join(least, "root").select("fp", "first"), "fp", "left")
    chosen = F.col("first").isNull() | (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("th") == F.col("first.th")))
    return out.select("doc_id", "th", "n_shingles", F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("component_id"), chosen.alias("chosen"))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", region: int = REGION, set_bytes: int = SET_BYTES) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row; see the module's text."""
    out = _resolved(docs, width, percent, id_col, text_col, region, set_bytes)
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of ``docs``, that of the least id, in all its columns; of a group without ids one row stays too.

    Rows without shingles belong to no group: they stay, and rows that repeat in id and text count once unless the id is null.
    """
    rows = _resolved(docs, width, percent, id_col, text_col, REGION, SET_BYTES).filter("chosen")
    alone = F.col("doc_id").isNull() & (F.col("n_shingles") == 0)
    kept = rows.groupBy(F.col("doc_id").alias("_id"), F.col("th").alias("_th")).agg((F.bool_and(alone) | (F.count("*") == 1)).alias("_once"))
    kept = written(kept, "kept")
    match = docs[id_col].eqNullSafe(kept["_id"]) & (F.xxhash64(docs[text_col]) == kept["_th"])
    once = docs.join(kept.filter("_once"), match, "left_semi")
    again = docs.join(kept.filter("not _once"), match, "left_semi")
    if kept.filter("not _once").isEmpty():
        return once
    whole = F.struct(*docs.columns)
    turn = F.row_number().over(Window.partitionBy(F.col(id_col), F.col(text_col)).orderBy(F.to_json(whole)))
    marked = again.select(whole.alias("_row"), turn.alias("_turn"))
    return once.unionByName(marked.filter("_turn = 1").select("_row.*"))

"""Exact duplicates through an extendible-hash index on shared files.

A text's key is a 64-bit hash of its normal form, lower-cased A-Z. The index is a directory of key prefixes and a bucket for each.
Its buckets hold the texts of those keys that several rows have; a key of one row needs no comparison, and a Bloom filter keeps nearly all
such texts from being moved. The directory starts with as many bits as the bytes need; then buckets that hold more than
``BUCKET`` are split by the next bit of the key, over and over, which doubles the directory's reach where it is needed. An owner task has
a range of keys, and so some whole buckets. It reads its texts in order of bucket and key, chains the different texts of a key and compares
bytes along the chain. What it writes is the index: the bucket, the key, the link of the chain, and each link's text once. Groups are the
links, so equal hashes alone never make two texts equal.

Scale: fingerprints of some 60 bytes a row are written once and serve the counts, the directory and the way back to rows. Copies collapse
inside map tasks (runs of ``RUN`` bytes of different texts) before the shuffle, so a group that holds a third of the rows comes to its owner as one
text from each run, one after the other. An owner holds the chain of one key, of one text but for collisions. Groups of more than
a thousandth of all rows, a thousand at most, are broadcast on the way back; the rest is joined by key. Every intermediate table lies in
the shared folder, and the driver sees counts only.

Defined cases: a null text is an empty text, and empty texts are copies of each other; long texts are compared whole; of equal texts the row
with the largest id stays, of rows that repeat this id one of them; a null id is smaller than any other, and a group of null ids has a
null keep_id; other columns are ignored; an empty table gives an empty result. Two texts of one SHA-256 digest would be an error.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.llm._arrow import tidy
from vellum.llm._shared import broadcast_if_small, drop_written, written
from vellum.operators import bloom

#: Bytes of texts in a bucket, in an owner's range of keys, and of the different texts that a map task collapses together.
BUCKET, OWNER, RUN = 16 << 20, 64 << 20, 32 << 20
#: Owners of even a small index, where its directory has so many slots.
SPREAD = 16
#: A group of more than this share of the rows is broadcast on the way back.
HEAVY = 1_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normal(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)


def key_of(text: Column, bits: int) -> Column:
    """The first ``bits`` bits of a text's hash; the rest are zeros."""
    return F.xxhash64(text).bitwiseAND(F.lit(-1 << (64 - bits)))


def prefix(key: str | Column, depth: int) -> Column:
    return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("bigint")


def grow_directory(keys: DataFrame, bucket: int = BUCKET, bits: int = 64) -> tuple[DataFrame, int]:
    """The directory (slot, bucket, depth) of a table (key, n_bytes) and its depth: slots are all prefixes of that many bits.

    A text counts an eighth of a bucket at most, so a bucket of long texts still holds eight keys and the directory stays in
    proportion to the bytes. A bucket of one key is never split.
    """
    keys = keys.select("key", F.least("n_bytes", F.lit(max(1, bucket // 8))).alias("load"))
    total = keys.agg(F.sum("load")).first()[0] or 0
    depth = min(bits, max(0, math.ceil(math.log2(max(1, total / bucket)))))
    rest, done = keys, []
    while True:
        counted = written(rest.groupBy(prefix("key", depth).alias("prefix")).agg(F.sum("load").alias("load"), F.count("*").alias("n")), "directory")
        full = (F.col("load") > bucket) & (F.col("n") > 1) & F.lit(depth < bits)
        done.append(counted.filter(~full).select("prefix", F.lit(depth).alias("depth")))
        split = counted.filter(full).select("prefix")
        if split.isEmpty():
            break
        rest = rest.withColumn("prefix", prefix("key", depth)).join(broadcast_if_small(split), "prefix", "left_semi").select("key", "load")
        depth += 1
    parts = [d.select(F.expr(f"shiftleft(prefix, {depth} - depth)").alias("bucket"), "depth", F.explode(F.expr(f"sequence(0L, shiftleft(1L, {depth} - depth) - 1)")).alias("i")) for d in done]
    all_parts = parts[0]
    for part in parts[1:]:
        all_parts = all_parts.union(part)
    directory = written(all_parts.select((F.col("bucket") + F.col("i")).alias("slot"), "bucket", "depth"), "directory")
    return directory, depth


def _collapser(limit: int):
    """Of (key, digest, text) each text once for every run of ``limit`` bytes of different texts."""

    @tidy
    def collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        size = 0
        for batch in batches:
            stay = []
            for i, (digest, length) in enumerate(zip(batch.column(1).to_pylist(), pa.compute.binary_length(batch.column(2)).to_pylist(), strict=True)):
                if digest not in seen:
                    seen.add(digest)
                    stay.append(i)
                    size += length + 64
                if size > limit:
                    seen, size = set(), 0
            yield batch.take(pa.array(stay, pa.int64()))

    return collapse


@tidy
def _owner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chains of the texts of each key, from rows (bucket, key, digest, text) in order of bucket and key."""
    names = ["bucket", "key", "link", "digest", "text"]
    key, chain = None, []
    for batch in batches:
        out = [[] for _ in names]
        texts = batch.column(3)
        for i, (bucket, k, digest) in enumerate(zip(*(c.to_pylist() for c in batch.columns[:3]), strict=True)):
            if k != key:
                key, chain = k, []
            text = texts[i].as_py()
            if any(text == own for _, own in chain):
                continue
            if any(digest == own for own, _ in chain):
                raise ValueError("two texts of one digest")
            for column, x in zip(out, (bucket, k, len(chain), digest, text), strict=True):
                column.append(x)
            chain.append((digest, text))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()), strict=True)], names)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 64) -> DataFrame:
    """(id, row, key, digest, n_bytes) of every row."""
    rows = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), normal(F.col(text_col)).alias("text"))
    return written(rows.select("id", "row", key_of(F.col("text"), bits).alias("key"), F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"), F.octet_length("text").alias("n_bytes")), "fingerprints")


def text_index(docs: DataFrame, sizes: DataFrame, text_col: str = "text", bits: int = 64, bucket: int = BUCKET, owner: int = OWNER, run: int = RUN) -> DataFrame:
    """(bucket, key, link, digest, text): the index of the texts whose key several rows have. ``sizes``: (key, digest, n, n_bytes)."""
    keys = written(sizes.groupBy("key").agg(F.sum("n").alias("n"), F.sum("n_bytes").alias("n_bytes")).filter("n > 1").select("key", "n_bytes"), "keys")
    directory, depth = grow_directory(keys, bucket, bits)
    n, n_bytes = keys.agg(F.count("*"), F.coalesce(F.sum("n_bytes"), F.lit(0))).first()
    text = docs.select(normal(F.col(text_col)).alias("text")).withColumn("key", key_of(F.col("text"), bits))
    if bloom.slices_for(n) <= bloom.MOST:
        text = bloom.with_hits(text, "key", bloom.bloom_filter(keys, "key", bloom.slices_for(n)), bloom.slices_for(n)).filter("_hit")
    found = text.select("key", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"), F.col("text").cast("binary").alias("text"))
    few = found.mapInArrow(_collapser(run), "key bigint, digest binary, text binary")
    placed = few.withColumn("slot", prefix("key", depth)).join(broadcast_if_small(directory), "slot")
    owners = max(-(-n_bytes // owner), min(1 << depth, SPREAD))
    mine = placed.select(F.expr(f"cast(cast(slot as decimal(20, 0)) * {owners} div {1 << depth} as int)").alias("owner"), "bucket", "key", "digest", "text")
    ranges = mine.repartition(owners, "owner").select("bucket", "key", "digest", "text").sortWithinPartitions("bucket", "key")
    return written(ranges.mapInArrow(_owner, "bucket bigint, key bigint, link int, digest binary, text binary"), "index")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 64, bucket: int = BUCKET, owner: int = OWNER, run: int = RUN) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row."""
    prints = fingerprints(docs, id_col, text_col, bits)
    sizes = written(prints.groupBy("key", "digest").agg(F.count("*").alias("n"), F.max(F.struct("id", (-F.col("row")).alias("row"))).alias("top"), F.max("n_bytes").alias("n_bytes")), "sizes")
    index = text_index(docs, sizes, text_col, bits, bucket, owner, run)
    linked = sizes.join(index.select("key", "digest", "link"), ["key", "digest"], "left")
    known = linked.select("key", "digest", "n", "top", F.when((F.col("n") > 1) & F.col("link").isNull(), F.raise_error(F.lit("a text is missing in the index"))).otherwise(F.col("link")).alias("link"))
    groups = known.filter("link is not null").groupBy("key", "link").agg(F.sum("n").alias("group_size"), F.max("top").alias("top"), F.collect_set("digest").alias("digests"))
    several = written(groups.filter("group_size > 1").select("key", F.explode("digests").alias("digest"), "group_size", F.col("top.id").alias("keep_id"), (-F.col("top.row")).alias("keep_row")), "groups")
    total = prints.count()
    heavy = F.broadcast(several.filter(F.col("group_size") * HEAVY > total))  # a thousand groups at most
    both = ["key", "digest"]
    hot = prints.join(heavy, both)
    cold = prints.join(heavy, both, "left_anti").join(several.filter(F.col("group_size") * HEAVY <= total), both, "left")
    alone = F.col("group_size").isNull()
    rows = hot.unionByName(cold)
    return rows.select(
        F.col("id").alias("doc_id"), F.when(alone, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
        (alone | (F.col("row") == F.col("keep_row"))).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"),
    )

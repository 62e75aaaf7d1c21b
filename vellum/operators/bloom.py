"""Bloom filters as tables: built by partial aggregation, probed by a broadcast before anything is shuffled.

A filter is cut into slices of ``SLICE`` bits, a row each, dealt by a hash of the key. There are about ten bits a key and at most
``MOST`` slices (128 MB), so a filter may always be broadcast. A key that was put in is always found; of other keys about one of a hundred is
found by mistake. Null keys are never put in and never found.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a slice, bits and places of a key, and the most slices.
SLICE, BITS_A_KEY, PLACES, MOST = 1 << 18, 10, 5, 4_096
#: Lists of keys up to this length are broadcast themselves.
FEW = 100_000


def slices_for(n_keys: int) -> int:
    return max(1, -(-n_keys * BITS_A_KEY // SLICE))


def _slice(key: Column, slices: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(slices)).cast("int")


def _places(key: Column) -> list[Column]:
    """The bits of a key in its slice: double hashing (Kirsch and Mitzenmacher 2006)."""
    both = F.xxhash64(key, F.lit(1))
    one, two = both.bitwiseAND(0xFFFFFFF), F.shiftrightunsigned(both, 32).bitwiseOR(1)
    return [(one + F.lit(i) * two).bitwiseAND(SLICE - 1).cast("int") for i in range(PLACES)]


def bloom_filter(keys: DataFrame, key: str, slices: int) -> DataFrame:
    """(_slice, _words): the filter of a column of keys; every slice has a row."""
    spark, words = keys.sparkSession, SLICE // 64
    put = keys.select(F.col(key).alias("k")).filter("k is not null").select(_slice(F.col("k"), slices).alias("_slice"), F.explode(F.array(*_places(F.col("k")))).alias("p"))
    bits = put.select("_slice", F.shiftright("p", 6).alias("w"), F.expr("shiftleft(1L, p & 63)").alias("m"))
    none = spark.range(slices * words).select(F.expr(f"cast(id div {words} as int)").alias("_slice"), F.expr(f"cast(id % {words} as int)").alias("w"), F.lit(0).cast("bigint").alias("m"))
    full = bits.union(none).groupBy("_slice", "w").agg(F.bit_or("m").alias("m"))
    return full.groupBy("_slice").agg(F.array_sort(F.collect_list(F.struct("w", "m"))).alias("a")).select("_slice", F.transform("a", lambda x: x["m"]).alias("_words"))


def with_hits(rows: DataFrame, key: str, bloom: DataFrame, slices: int, name: str = "_hit") -> DataFrame:
    """The rows with a flag: false where the key was surely never put into the filter."""
    if slices > MOST:
        raise ValueError("too many keys for a filter that is broadcast")
    seen = rows.join(F.broadcast(bloom.withColumnRenamed("_slice", "_of")), _slice(F.col(key), slices) == F.col("_of"), "left")
    hit = F.lit(True)
    for place in _places(F.col(key)):
        hit = hit & (F.call_function("shiftrightunsigned", F.get("_words", F.shiftright(place, 6)), place.bitwiseAND(63)).bitwiseAND(1) == 1)
    return seen.withColumn(name, F.col(key).isNotNull() & F.coalesce(hit, F.lit(False))).drop("_of", "_words")


def without(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """The rows whose key is not in ``done``: an exact anti-join that shuffles no row whose key is surely new.

    Few finished keys are broadcast. Of more a filter is made; rows that it does not find stay where they are, only possible hits meet
    the list. A list too long for a filter is joined by key. Rows without a key are never done; rows that repeat stay each.
    """
    keys = done.select(key).filter(F.col(key).isNotNull()).distinct()
    n = keys.count()
    match = lambda some, by: some.join(by, key, "left_anti").select(*some.columns)
    if n <= FEW:
        return match(rows, F.broadcast(keys))
    slices = slices_for(n)
    if slices > MOST:
        return match(rows, keys)
    flagged = with_hits(rows, key, bloom_filter(keys, key, slices), slices)
    return flagged.filter(~F.col("_hit")).drop("_hit").union(match(flagged.filter("_hit").drop("_hit"), keys))

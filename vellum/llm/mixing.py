"""Mixing sources to target weights by weighted fair queueing. DataFrame functions only.

Every source is a stream of its documents in a shuffled order (the order of md5 of the id), gone through up to
``repeats`` times. A copy's virtual finish time is the number of words of its source up to its end, divided by the
source's target. Copies are put in the order of their finish times over all sources, and the mix is cut where its
words reach the total budget.

Targets: sources in code point order, null last, weigh ``weights`` in turn and share ``share`` times all words; none
gets more than ``repeats`` times its own words, and what is above goes to the others by weight until none is above.
With c the ratio of that limit to the weight, a source is at its limit exactly if giving every source
min(its limit, c * weight) stays inside the budget, so one sorted running sum over the sources finds them all.

Scale: running sums have two levels. Words are summed by (source, slice of the shuffle) and the running total inside
a slice starts from the total of the slices before it. A source has one slice for every ``SLICE`` of its rows, so one that holds
a third of all rows is spread over as many tasks. The cut is found the same way over ranges of finish time, which are bounded in number;
rows are only sorted inside the one range that holds the cut, in parts. This stands for one global sort by finish time cut at the
budget, and gives the same rows.

Ties: copies that finish together go by source, copy, shuffle, id and row.

Defined cases: very long texts count whole; a null or empty text has size 0 and is never taken; sources may be null; repeated rows count each;
an empty table gives an empty result; columns other than id, text and source are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vellum.llm._shared import broadcast_if_small, written

#: Rows in a slice of the shuffle and in a range of finish times, on average.
SLICE = 4_000
#: The table of sources is broadcast up to so many rows; beyond, it is joined by source.
SOURCES = 10_000
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: F.Column) -> F.Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, repeats: int = 2) -> DataFrame:
    """(source, source_size, rows, target) from (source, size): one row a source."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    everything = Window.partitionBy()
    by_name = Window.partitionBy().orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = totals.select(
        "source", "source_size", "rows", weight.cast("double").alias("weight"), (F.lit(float(repeats)) * F.col("source_size")).alias("most"),
        (F.lit(share) * F.sum("source_size").over(everything)).alias("budget"),
    ).withColumn("level", F.col("most") / F.col("weight"))
    up_to = Window.partitionBy().orderBy("level", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)
    filled = F.sum("most").over(up_to) + F.col("level") * (F.sum("weight").over(everything) - F.sum("weight").over(up_to))
    full = ranked.withColumn("full", filled <= F.col("budget"))
    left = F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("most"))).over(everything), F.lit(0.0))
    open_weight = F.sum(F.when(~F.col("full"), F.col("weight"))).over(everything)
    return full.select("source", "source_size", "rows", F.when(F.col("full"), F.col("most")).otherwise(F.col("weight") * (left / open_weight)).alias("target"))


def fair_mix(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, repeats: int = 2, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, th, size, source_size, target, taken, copies) for each row of ``docs``; th is a hash of its text."""
    rows = written(
        docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.xxhash64(text_col).alias("th"), word_count(F.col(text_col)).alias("size")),
        "sizes",
    )
    n, total = rows.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    budget = share * total
    targets = source_targets(rows, weights, share, repeats).withColumnRenamed("source", "s")
    targets = F.broadcast(targets) if targets.limit(SOURCES + 1).count() <= SOURCES else targets

    shuffled = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    slices = F.ceil(F.col("rows") / F.lit(SLICE))
    part = F.floor(F.conv(F.substring("order", 1, 8), 16, 10).cast("double") / F.lit(2.0**32) * slices).cast("bigint")
    sized = rows.join(targets, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    dealt = sized.withColumn("order", shuffled).withColumn("part", part)
    sums = dealt.groupBy("source", "part").agg(F.sum("size").alias("words"))
    before = F.coalesce(F.sum("words").over(Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sums.select(F.col("source").alias("s"), F.col("part").alias("p"), before.alias("before"))
    inside = F.sum("size").over(Window.partitionBy("source", "part").orderBy("order", "doc_id", "size", "row").rowsBetween(Window.unboundedPreceding, 0))
    placed = dealt.withColumn("inside", inside).join(starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p")))
    end = F.col("before") + F.col("inside")
    placed = written(placed.select("row", "doc_id", "source", "th", "size", "source_size", "target", "order", end.alias("end")), "placed")

    ranges = max(64, -(-repeats * n // SLICE))
    finish = F.when(F.col("target") > 0, (F.col("copy") * F.col("source_size") + F.col("end")) / F.col("target"))
    span = F.when(F.col("finish") <= 1, F.floor(F.col("finish") * ranges)).otherwise(ranges + F.floor((1 - 1 / F.col("finish")) * ranges))
    copies = (
        placed.filter("size > 0 and target > 0").withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
        .withColumn("finish", finish).withColumn("span", span.cast("bigint"))
    )
    running = F.sum("words").over(Window.partitionBy().orderBy("span").rowsBetween(Window.unboundedPreceding, 0))
    by_span = copies.groupBy("span").agg(F.sum("size").alias("words"), F.count("*").alias("n")).withColumn("upto", running)
    cut = by_span.filter(F.col("upto") > budget).orderBy("span").select("span", "n", (F.col("upto") - F.col("words")).alias("before")).first()
    cut_span, cut_rows, cut_before = (cut["span"], cut["n"], cut["before"]) if cut else (2**62, 0, 0)

    # many copies may finish at one time, so the range of the cut is sorted in parts of its own
    keys = ["finish", F.col("source").asc_nulls_last(), "copy", "order", "doc_id", "row"]
    ranged = copies.filter(F.col("span") == cut_span).repartitionByRange(1 + cut_rows // (16 * SLICE), *keys)
    parts = written(ranged.withColumn("piece", F.spark_partition_id()), "cut")
    sums = parts.groupBy("piece").agg(F.sum("size").alias("words"))
    before = F.coalesce(F.sum("words").over(Window.partitionBy().orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = F.broadcast(sums.select("piece", before.alias("earlier")))  # one row for each 16 * SLICE rows of the range
    in_order = Window.partitionBy("piece").orderBy(*keys).rowsBetween(Window.unboundedPreceding, 0)
    last = parts.withColumn("inside_cut", F.sum("size").over(in_order)).join(starts, "piece").withColumn("upto", cut_before + F.col("earlier") + F.col("inside_cut"))
    last = last.filter(F.col("upto") <= budget).groupBy("row").agg(F.count("*").alias("more"))
    whole = sum((F.when((F.col("size") > 0) & (F.col("target") > 0) & (_span(c, ranges) < cut_span), 1).otherwise(0) for c in range(repeats)), F.lit(0))
    got = (whole + F.coalesce("more", F.lit(0))).cast("bigint")
    return placed.join(last, "row", "left").select("doc_id", "source", "th", "size", "source_size", "target", (F.col("size") * got).alias("taken"), got.alias("copies"))


def _span(copy: int, ranges: int) -> F.Column:
    finish = F.try_divide(copy * F.col("source_size") + F.col("end"), F.col("target"))
    return F.when(finish <= 1, F.floor(finish * ranges)).otherwise(ranges + F.floor((1 - F.try_divide(F.lit(1), finish)) * ranges)).cast("bigint")


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, in the columns of ``docs``. Ids may repeat.

    Texts are shuffled once, to meet the number of their copies by id, source and a hash of the text. Rows that agree in these
    share their copies evenly.
    """
    id_col, source_col, text_col = (settings.get(k, v) for k, v in (("id_col", "doc_id"), ("source_col", "source"), ("text_col", "text")))
    mix = fair_mix(docs, **settings).groupBy(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("th").alias("_th"))
    shares = written(mix.agg(F.count("*").alias("_rows"), F.sum("copies").alias("_copies")).filter("_copies > 0"), "shares")
    rows = docs.select(F.struct(*docs.columns).alias("_whole"))
    of = lambda c: F.col(f"_whole.`{c}`")
    match = of(id_col).eqNullSafe(F.col("_id")) & of(source_col).eqNullSafe(F.col("_source")) & (F.xxhash64(of(text_col)) == F.col("_th"))
    again = lambda df, copies: df.select("_whole", F.explode(F.sequence(F.lit(1), copies.cast("int")))).select("_whole.*")
    out = again(rows.join(shares.filter("_rows = 1"), match), F.col("_copies"))
    several = shares.filter("_rows > 1")
    if several.isEmpty():
        return out
    turn = F.row_number().over(Window.partitionBy("_id", "_source", "_th").orderBy(F.to_json("_whole")))
    joined = rows.join(broadcast_if_small(several), match).withColumn("_mine", F.floor(F.col("_copies") / F.col("_rows")) + (turn <= F.col("_copies") % F.col("_rows")).cast("bigint"))
    return out.unionByName(again(joined.filter("_mine > 0"), F.col("_mine")))

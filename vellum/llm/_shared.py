"""Connected components, bounded samples and broadcasts for the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vellum.session import new_path, shared_dir, written

__all__ = ["broadcast_if_small", "components", "drop_written", "hashed_sample", "new_path", "shared_dir", "written"]


def drop_written(df: DataFrame) -> None:
    """Deletes a table made by ``written`` that is not needed any more."""
    spark = df.sparkSession
    tops = {f.rsplit("/part-", 1)[0] for f in df.inputFiles()}
    for top in tops:
        if top.replace("file:///", "file:/").startswith(shared_dir(spark).replace("file:///", "file:/")):
            path = spark._jvm.org.apache.hadoop.fs.Path(top)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Edges up to which their nodes are broadcast.
FEW_EDGES = 200_000


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): for each node of an edge list the smallest node that it is connected with.

    Alternating large-star and small-star steps (Kiveris et al. 2014): every step is an aggregation by node and a
    join that Spark can split at hot nodes, and each round is written out. Rounds grow with the logarithm of the
    longest path. Loops and repeated edges are allowed; an empty list gives no rows. While the edges are few, the least
    neighbours are broadcast, so a hot node's edges stay spread over all tasks; beyond, adaptive plans split it.
    """
    hi, lo = F.greatest(a, b), F.least(a, b)
    now = written(edges.filter(F.col(a) != F.col(b)).select(hi.alias("u"), lo.alias("v")).distinct(), "edges")
    before = None
    while True:
        mark = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if mark == before:
            break
        before = mark
        near = F.broadcast if mark[0] <= FEW_EDGES else lambda df: df  # at most two rows an edge
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(near(least), "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        pairs = large.join(near(least), "u")
        small = pairs.select(F.col("v").alias("u"), F.col("m").alias("v")).union(pairs.select("u", F.col("m").alias("v")))
        after = written(small.filter(F.col("u") != F.col("v")).distinct(), "edges")
        drop_written(now)
        now = after
    roots = now.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())


#: A table of counts by label is broadcast up to so many rows; beyond, it is joined by its key.
LABELS = 10_000


def broadcast_if_small(df: DataFrame, limit: int = 100_000) -> DataFrame:
    """Marks ``df`` for broadcast after counting at most ``limit`` + 1 of its rows."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def hashed_sample(rows: DataFrame, by: str, limit: F.Column) -> DataFrame:
    """(id, by) of at most ``limit`` rows of each value of ``by``, the same ones in every run: those of the least hashes of ``id``.

    The counts say which share of the hashes holds the rows wanted and six standard deviations more, so only those few are sorted.
    """
    counts = rows.groupBy(by).agg(F.count("*").alias("total"))
    counts = F.broadcast(counts) if counts.limit(LABELS + 1).count() <= LABELS else counts
    order = F.md5(F.coalesce(F.col("id").cast("string"), F.lit("")))
    place = F.conv(F.substring("order", 1, 8), 16, 10).cast("double") / F.lit(2.0**32)
    few = rows.select("id", by).withColumn("order", order).join(counts, by).filter(place * F.col("total") <= limit + 6 * F.sqrt(limit) + 20)
    ranked = few.withColumn("n", F.row_number().over(Window.partitionBy(by).orderBy("order", "id")))
    return ranked.filter(F.col("n") <= limit).select("id", by)

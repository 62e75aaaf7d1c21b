"""Running values over groups of any size: slices in order, a window inside each, and what earlier slices hand on.

Rows are range-partitioned by group and order, so a group of all rows is spread over all slices. The slices are written once, with their
numbers. A window runs inside (slice, group); one row a slice and group says what it hands on, and these few rows are added up in
order of the slices. Of the groups in a slice only the first can have begun in an earlier one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.session import written

#: A table of up to so many rows, counted, is one window's work, and so is a group of up to HOT rows; larger ones are cut into slices.
FEW, HOT = 100_000, 1_000_000


def sliced(df: DataFrame, by: list[str], order: list) -> DataFrame:
    """The rows with the number of their slice (_slice). Rows that are equal in group and order are in one slice."""
    return written(df.repartitionByRange(*by, *order).withColumn("_slice", F.spark_partition_id()), "slices")


def _same(by: list[str]) -> Column:
    out = F.col("_slice") == F.col("_s")
    for c in by:
        out = out & F.col(c).eqNullSafe(F.col(f"_b_{c}"))
    return out


def carried_last(df: DataFrame, col: str, by: list[str], order: list, name: str) -> DataFrame:
    """The last value that is not null up to each row of its group. Groups of more than HOT rows are told by a count and go in slices."""
    window = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    plain = lambda rows: rows.withColumn(name, F.last(col, ignorenulls=True).over(window))
    hot = df.groupBy(*by).agg(F.count("*").alias("_n")).filter(F.col("_n") > HOT).select(F.lit(0).alias("_slice"), *by)
    if hot.isEmpty():
        return plain(df)
    hot = written(hot, "hot")
    keys = F.broadcast(hot.select(F.col("_slice").alias("_s"), *(F.col(c).alias(f"_b_{c}") for c in by)))  # one for each HOT rows at most
    both = df.withColumn("_slice", F.lit(0))
    rest = both.join(keys, _same(by), "left_anti").drop("_slice")
    return plain(rest).unionByName(_carried_in_slices(both.join(keys, _same(by), "left_semi").drop("_slice"), col, by, order, name))


def _carried_in_slices(df: DataFrame, col: str, by: list[str], order: list, name: str) -> DataFrame:
    inner = Window.partitionBy("_slice", *by).orderBy(*order)
    rows = sliced(df, by, order).withColumn("_last", F.last(col, ignorenulls=True).over(inner.rowsBetween(Window.unboundedPreceding, 0)))
    ends = rows.withColumn("_n", F.row_number().over(inner)).groupBy("_slice", *by).agg(F.max_by("_last", "_n").alias("_end"))
    earlier = Window.partitionBy(*by).orderBy("_slice")
    handed = ends.withColumn("_from", F.last("_end", ignorenulls=True).over(earlier.rowsBetween(Window.unboundedPreceding, -1))).filter("_from is not null")
    handed = handed.select(F.col("_slice").alias("_s"), *(F.col(c).alias(f"_b_{c}") for c in by), "_from")
    filled = rows.join(F.broadcast(handed), _same(by), "left")  # at most a row for each slice
    return filled.withColumn(name, F.coalesce("_last", "_from")).drop("_slice", "_last", "_s", "_from", *(f"_b_{c}" for c in by))


def running_sum(df: DataFrame, value: str, by: list[str], order: list, name: str, total: str) -> DataFrame:
    """The sum of a group's values up to each row, and of all of them. A group has no two rows of equal order."""
    df = written(df, "values")
    if df.count() <= FEW:
        group = Window.partitionBy(*by)
        return df.withColumn(name, F.sum(value).over(group.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))).withColumn(total, F.sum(value).over(group))
    rows = sliced(df, by, order)
    parts = rows.groupBy("_slice", *by).agg(F.sum(value).alias("_part"))
    earlier = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_before", F.coalesce(F.sum("_part").over(earlier), F.lit(0))).withColumn(total, F.sum("_part").over(Window.partitionBy(*by)))
    parts = parts.select(F.col("_slice").alias("_s"), *(F.col(c).alias(f"_b_{c}") for c in by), "_before", total)
    inner = Window.partitionBy("_slice", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("_in", F.sum(value).over(inner)).join(parts, _same(by)).withColumn(name, F.col("_before") + F.col("_in")).drop("_slice", "_in", "_s", "_before", *(f"_b_{c}" for c in by))


def numbered(df: DataFrame, order: list, name: str) -> DataFrame:
    """All rows numbered from 1 in an order that has no ties. The counts of the slices, one a slice, make the offsets."""
    df = written(df, "values")
    if df.count() <= FEW:
        return df.withColumn(name, F.row_number().over(Window.orderBy(*order)))
    rows = sliced(df, [], order)
    counts = rows.groupBy("_slice").agg(F.count("*").alias("n")).agg(F.array_sort(F.collect_list(F.struct("_slice", "n"))).alias("a"))
    offsets = F.transform("a", lambda x, i: F.struct(x["_slice"].alias("_s"), F.aggregate(F.slice("a", 1, i), F.lit(0).cast("bigint"), lambda s, y: s + y["n"]).alias("_before")))
    starts = counts.select(F.inline(offsets))
    place = F.row_number().over(Window.partitionBy("_slice").orderBy(*order))
    return rows.withColumn("_in", place).join(F.broadcast(starts), F.col("_slice") == F.col("_s")).withColumn(name, (F.col("_before") + F.col("_in")).cast("int")).drop("_slice", "_in", "_s", "_before")

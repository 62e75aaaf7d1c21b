"""Grouped statistics of survey microdata: top labels, shares, modes, weighted means and quantiles, orders, reshaping."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.operators.open_records import column_order, found_types
from vellum.operators.running import numbered, running_sum

#: A side of a join is broadcast only up to so many rows; beyond, the join is by key.
SMALL = 100_000


def broadcast_if_small(df: DataFrame, limit: int = SMALL) -> DataFrame:
    """Marks ``df`` for broadcast after counting at most ``limit`` + 1 of its rows."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def count_by(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n"))


def top_labels(df: DataFrame, col: str, k: int, exclude_prefix: str | None = None, ord_col: str | None = None) -> DataFrame:
    """(label, n, rank) of the k most frequent labels; ties go to the smaller order, then the smaller label."""
    kept = df.filter(F.col(col).isNotNull())
    if exclude_prefix:
        kept = kept.filter(~F.col(col).startswith(exclude_prefix))
    counts = kept.groupBy(F.col(col).alias("label")).agg(F.count("*").alias("n"), F.min(ord_col or col).alias("o"))
    top = counts.orderBy(F.desc("n"), "o", "label").limit(k)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), "o", "label"))).select("label", "n", "rank")


def keep_labels(df: DataFrame, top: DataFrame, col: str) -> DataFrame:
    """Rows whose label is among ``top``, which has at most the k rows it was cut to."""
    return df.join(F.broadcast(top.select(F.col("label").alias(col))), col, "left_semi")


def share(df: DataFrame, by: list[str], within: list[str], n: str = "n", name: str = "pct") -> DataFrame:
    """Counts by ``by`` and their share in ``within``; a null group counts in the denominator."""
    counts = df.groupBy(*by).agg(F.count("*").alias(n))
    return counts.withColumn(name, F.col(n) / F.sum(n).over(Window.partitionBy(*within)))


def spread_value(df: DataFrame, by: list[str], cond: Column, col: str, name: str) -> DataFrame:
    """Puts the value of one row of each group on all its rows; null without such a row."""
    return df.withColumn(name, F.max(F.when(cond, F.col(col))).over(Window.partitionBy(*by)))


def order_by_stat(df: DataFrame, label: str, stat: str, ascending: bool = True, name: str = "ord") -> DataFrame:
    """Numbers the labels by a statistic that is constant within each of them; missing statistics come last."""
    stats = df.groupBy(label).agg(F.max(stat).alias("_stat"))
    order = F.col("_stat").asc_nulls_last() if ascending else F.col("_stat").desc_nulls_last()
    places = numbered(stats, [order, F.col(label)], name).select(F.col(label).alias("_label"), name)
    return df.join(broadcast_if_small(places), F.col(label).eqNullSafe(F.col("_label")), "left").drop("_label")


def mode_by(df: DataFrame, by: list[str], col: str, name: str = "mode") -> DataFrame:
    """Most frequent value of each group; the smallest on ties; nulls never count."""
    counts = df.groupBy(*by, col).agg(F.count("*").alias("_n"))
    best = F.min(F.when(F.col(col).isNotNull(), F.struct((-F.col("_n")).alias("n"), F.col(col).alias("v"))))
    return counts.groupBy(*by).agg(best["v"].alias(name))


def stat_back(df: DataFrame, by: list[str], stat: DataFrame) -> DataFrame:
    """Joins a statistic of each group onto the group's rows."""
    return df.join(broadcast_if_small(stat), by, "left")


def weighted_mean(x: Column | str, w: Column | str) -> Column:
    """Mean of x by weight; rows without x are left out, and a missing weight of a row with x makes the result null."""
    x, w = (F.col(c) if isinstance(c, str) else c for c in (x, w))
    x = x.cast("double")
    total = F.sum(F.when(x.isNotNull(), w))
    return F.when(F.count_if(x.isNotNull() & w.isNull()) == 0, F.try_divide(F.sum(x * w), total))


def weighted_quantiles(df: DataFrame, by: list[str], x: str, w: str, probs: list[float], names: list[str] | None = None) -> DataFrame:
    """Quantiles under real-valued weights: one row a group, one column a probability.

    Values are summed up first, and their running sums go from slice to slice, so a group may hold all rows and as many values. With n the sum of the weights and
    o = 1 + (n - 1) p the result lies between the values at max(floor(o), 1) and the next one, but not beyond n.
    """
    names = names or [f"q{round(p * 100)}" for p in probs]
    sums = df.filter(F.col(x).isNotNull() & (F.coalesce(F.col(w), F.lit(0)) != 0)).groupBy(*by, x).agg(F.sum(w).alias("_t"))
    at = running_sum(sums, "_t", by, [x], "_cw", "_n")

    def value(v: Column) -> Column:
        return F.coalesce(F.min(F.when(F.col("_cw") >= v, F.col(x))), F.max(x)).cast("double")

    out = []
    for p, name in zip(probs, names, strict=True):
        o = 1 + (F.col("_n") - 1) * F.lit(p)
        low = F.greatest(F.floor(o), F.lit(1))
        high = F.least(low + 1, F.col("_n"))
        part = F.max(o - F.floor(o))
        out.append(((1 - part) * value(low) + part * value(high)).alias(name))
    return at.groupBy(*by).agg(*out)


def longer(df: DataFrame, ids: list[str], cols: list[str], name: str = "name", value: str = "value") -> DataFrame:
    """Columns to rows."""
    return df.unpivot(ids, cols, name, value)


def wider(df: DataFrame, by: list[str], name: str, value: str, names: list[str]) -> DataFrame:
    """Rows to the columns named; a column is null where there is no row."""
    return df.groupBy(*by).pivot(name, names).agg(F.first(value, True))


def facts_wide(df: DataFrame, col: str, keys: list[str] | None = None) -> DataFrame:
    """Entries of a map as columns: those named, or else all keys found, in order."""
    keys = column_order(found_types(df, col)) if keys is None else keys
    return df.select(*(c for c in df.columns if c != col), *(F.try_element_at(F.col(col), F.lit(k)).alias(k) for k in keys))


def union_all(*parts: DataFrame, missing: bool = False) -> DataFrame:
    """Rows of all parts; with ``missing`` their columns may differ."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=missing), parts)

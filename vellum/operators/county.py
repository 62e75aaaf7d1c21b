"""Statistics of areas: diversity, change between waves, regression residuals, adjusted rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def fips(code: Column | str) -> Column:
    """Five digits with leading zeros."""
    return F.lpad((F.col(code) if isinstance(code, str) else code).cast("string"), 5, "0")


def known(value: Column | str) -> Column:
    """A count, with -9, blank and unreadable text as null."""
    number = F.expr(f"try_cast(trim(cast({value} as string)) as double)") if isinstance(value, str) else value.cast("double")
    return F.when(number != -9, number)


def county_diversity(df: DataFrame, area: str | list[str], group: str, n: str) -> DataFrame:
    """(area, groups, total, largest_share, shannon, simpson) over the groups with a positive count."""
    areas = [area] if isinstance(area, str) else area
    sums = df.groupBy(*areas, group).agg(F.sum(n).alias("_n")).filter(F.col("_n") > 0)
    shares = sums.withColumn("_p", F.col("_n") / F.sum("_n").over(Window.partitionBy(*areas)))
    return shares.groupBy(*areas).agg(
        F.count("*").alias("groups"), F.sum("_n").alias("total"), F.max("_p").alias("largest_share"),
        (-F.sum(F.col("_p") * F.ln("_p"))).alias("shannon"), (1 - F.sum(F.col("_p") * F.col("_p"))).alias("simpson"),
    )


def wave_change(before: DataFrame, after: DataFrame, keys: list[str], value: str, how: str = "full") -> DataFrame:
    """(keys, before, after, change): relative change; null where a wave lacks the area or starts at 0."""
    a = before.select(*keys, F.col(value).alias("before"))
    b = after.select(*keys, F.col(value).alias("after"))
    return a.join(b, keys, how).withColumn("change", F.try_divide(F.col("after") - F.col("before"), F.col("before")))


def regress_residuals(df: DataFrame, y: str, x: str) -> DataFrame:
    """Adds fitted and residual of a straight line; the two coefficients are one row, joined to every row."""
    line = df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))
    fitted = F.col("intercept") + F.col("slope") * F.col(x)
    return df.join(F.broadcast(line)).withColumn("fitted", fitted).withColumn("residual", F.col(y) - fitted)


def adjusted_rate(df: DataFrame, factors: DataFrame, group: str, adherents: str, population: str, factor: str = "factor") -> DataFrame:
    """Adds rate and adjusted (rate times the group's factor, 1 where there is none)."""
    rate = F.try_divide(known(adherents), known(population))
    return df.join(factors.select(group, factor), group, "left").withColumn("rate", rate).withColumn("adjusted", rate * F.coalesce(factor, F.lit(1.0)))

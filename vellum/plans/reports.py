"""The survey's five reports, from one recoded table.

Each report is an aggregation of its own over the recoded respondents; the top labels are found once. Reports by period need
all years, so the years are never filtered in the shared table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.functions import scalars as S
from vellum.functions.recode import tradition
from vellum.operators import survey
from vellum.session import written

PERIODS = {"2008–2010": (2008, 2010), "2022–2024": (2022, 2024)}


def recoded(respondents: DataFrame) -> DataFrame:
    """Respondents with ``trad`` and its order ``trad_ord``."""
    return respondents.withColumn("_t", tradition()).withColumn("trad", F.col("_t.label")).withColumn("trad_ord", F.col("_t.ord")).drop("_t")


def top_traditions(people: DataFrame, k: int = 20, since: int = 2022) -> DataFrame:
    return survey.top_labels(people.filter(F.col("year") >= since), "trad", k, "Other", "trad_ord")


def age_shares(people: DataFrame, top: DataFrame) -> DataFrame:
    """Share of age buckets in each tradition, with the share and the order of the oldest."""
    kept = survey.keep_labels(people.filter("year >= 2022"), top, "trad")
    aged = kept.withColumn("_b", S.bucket(S.age(2024, "birthyr"), S.AGE_BREAKS, S.AGE_LABELS)).withColumn("age_bucket", F.col("_b.label"))
    shares = survey.share(aged, ["trad", "age_bucket"], ["trad"])
    spread = survey.spread_value(shares, ["trad"], F.col("age_bucket") == "75+", "pct", "pct75")
    return survey.order_by_stat(spread, "trad", "pct75")


def age_stats(people: DataFrame, top: DataFrame) -> DataFrame:
    """Mean and most frequent age of each tradition as rows, in the order of the mean."""
    kept = survey.keep_labels(people.filter("year >= 2022"), top, "trad").withColumn("age", S.age(2024, "birthyr")).filter("age is not null")
    stats = kept.groupBy("trad").agg(F.avg("age").alias("mean_age"), F.mode("age", True).cast("double").alias("mode_age"), F.count("*").alias("n"))
    ordered = survey.order_by_stat(stats, "trad", "mean_age")
    return survey.longer(ordered, ["trad", "n", "ord"], ["mean_age", "mode_age"], "stat", "age")


def young_shares(people: DataFrame, top: DataFrame) -> DataFrame:
    """Weighted share of those of 18 to 40 among adults by period, ordered by the later period from the highest."""
    aged = people.withColumn("age", S.age(F.col("year"), "birthyr")).withColumn("period", S.period("year", PERIODS)).filter("period is not null and age between 18 and 100")
    kept = survey.keep_labels(aged, top, "trad")
    shares = kept.groupBy("period", "trad").agg(survey.weighted_mean((F.col("age") <= 40).cast("int"), "weight").alias("pct_18_40"), F.count("age").alias("n_eff"))
    later = survey.spread_value(shares, ["trad"], F.col("period") == "2022–2024", "pct_18_40", "_later")
    return survey.order_by_stat(later, "trad", "_later", ascending=False).drop("_later").withColumn("trad_lab", S.wrap("trad", 18))


def years_left(people: DataFrame, top: DataFrame) -> DataFrame:
    """The calendar year by which 30, 40 and 50 percent of a tradition have reached the end age, in the order of the last."""
    aged = people.filter(F.col("year").between(2022, 2024)).withColumn("left", S.years_left(S.age(F.col("year"), "birthyr")))
    wide = survey.weighted_quantiles(survey.keep_labels(aged, top, "trad"), ["trad"], "left", "weight", [0.3, 0.4, 0.5], ["y30", "y40", "y50"])
    years = wide.select("trad", *(S.calendar_year(f"y{p}").alias(f"{p}%") for p in (30, 40, 50)), "y50")
    ordered = survey.order_by_stat(years, "trad", "y50")
    return survey.longer(ordered, ["trad", "ord"], ["30%", "40%", "50%"], "threshold", "death_year")


def boomer_shares(people: DataFrame, top: DataFrame) -> DataFrame:
    """Weighted share of those born from 1946 to 1964 among adults, in ascending order."""
    aged = people.filter(F.col("year").between(2022, 2024)).withColumn("age", S.age(F.col("year"), "birthyr")).filter("age between 18 and 100")
    shares = survey.keep_labels(aged, top, "trad").groupBy("trad").agg(survey.weighted_mean(S.cohort_flag("birthyr"), "weight").alias("pct_boomer"), F.count("age").alias("n_eff"))
    return survey.order_by_stat(shares, "trad", "pct_boomer")


def all_reports(respondents: DataFrame, k: int = 20) -> dict[str, DataFrame]:
    """Every report by name; the recoded table is written once for all of them."""
    people = written(recoded(respondents), "people")
    top = top_traditions(people, k)
    makers = (age_shares, age_stats, young_shares, years_left, boomer_shares)
    return {maker.__name__: maker(people, top) for maker in makers}

"""Writers: union CSV, sections, tables, and appends that add a key once."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Observation
from pyspark.sql import functions as F

from vellum.functions import scalars as S
from vellum.operators.open_records import text_table
from vellum.operators.records import append_new
from vellum.sources.table_files import write_files


def write_union_csv(df: DataFrame, path: str, col: str = "record", lead: tuple[str, ...] = (), mode: str = "all") -> None:
    """CSV of records (a map, a struct or a VARIANT) with differing keys: the union of all keys, leading columns first, the rest sorted.

    A missing value is ''; white space at the ends of values stays. Lists and objects become text as in ``open_records.as_text``. Keys that differ in case only are columns of their own.
    """
    with _exact_names(df.sparkSession):
        out = text_table(df, col, lead, mode=mode).write.mode("overwrite").option("header", True).option("emptyValue", "").option("escape", '"')
        out.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


@contextmanager
def _exact_names(spark: SparkSession) -> Iterator[None]:
    """Column names are told apart by case, too, while it is open."""
    was = spark.conf.get("spark.sql.caseSensitive")
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.caseSensitive", was)


def write_json(df: DataFrame, path: str, key: str | None = None, url_base: str | None = None, url_col: str = "URL") -> None:
    """JSON records, with a link made from the key."""
    out = df.withColumn(url_col, S.entity_url(key, url_base)) if key and url_base else df
    out.write.mode("overwrite").json(path)


def write_sections(sections: dict[str, DataFrame], path: str) -> None:
    """One JSON dataset a section, and all of them partitioned by section."""
    for name, df in sections.items():
        df.write.mode("overwrite").json(f"{path}/{name}")
    rows = None
    for name, df in sections.items():
        one = df.select(F.lit(name).alias("section"), F.to_json(F.struct("*")).alias("record"))
        rows = one if rows is None else rows.union(one)
    if rows is not None:
        rows.write.mode("overwrite").partitionBy("section").json(f"{path}/all")


def write_tables(cells: DataFrame, path: str) -> None:
    """Cells partitioned by section and year; page and table stay columns, so partitions do not become tiny files."""
    cells.write.mode("overwrite").partitionBy("section", "year_slug").parquet(path)


def write_table_files(rows: DataFrame, path: str, columns: list[str] | str) -> None:
    """One CSV file a table, ``<section>_<year_slug>/page_<p>_table_<t>.csv``, its rows in the order of ``row_idx``. ``columns`` may name an array.

    Tasks name the files, all of which appear at once; the driver moves one folder however many tables there are. A table is one file and
    so one task's work; the cells of many small tables belong in ``write_tables``.
    """
    name = F.concat(F.concat_ws("_", "section", "year_slug"), F.format_string("/page_%d_table_%d.csv", "page", "table_index"))
    write_files(rows.select(name.alias("_file"), "row_idx", *([columns] if isinstance(columns, str) else columns)), path, "_file", ["row_idx"], columns)


def write_text_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_text_files(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One text file for each row of a single text column. Opening a file is the work, so rows are dealt over all cores whatever they weigh."""
    spark = df.sparkSession
    tasks = max(3 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    df.repartition(tasks).write.mode(mode).option("maxRecordsPerFile", 1).option("lineSep", "\n").text(path)


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def append_new_to(path: str, new: DataFrame, key: str, order: list[Column | str] | None = None) -> dict[str, int]:
    """Appends the rows whose key is not in the table yet; a second run adds nothing. Gives the counts."""
    spark = new.sparkSession
    keys = spark.read.parquet(path).select(key) if _exists(spark, path) else new.select(key).limit(0)
    seen, added = Observation(), Observation()
    rows = append_new(new.observe(seen, F.count(F.lit(1)).alias("n")), keys, key, order, filtered=False).observe(added, F.count(F.lit(1)).alias("n"))
    rows.write.mode("append").parquet(path)  # both counts come from this one job; only the target's keys are read
    imported = added.get["n"]
    return {"imported": imported, "skipped": seen.get["n"] - imported}

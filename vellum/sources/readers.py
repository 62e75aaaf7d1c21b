"""Readers: table corpora, records, text folders, feeds, lists of finished keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.functions import scalars as S
from vellum.sources.table_files import read_rows

def file_name(col: str = "_metadata.file_path") -> Column:
    """The decoded base name of a row's file; a plus sign stays a plus sign."""
    return S.base_name(S.decoded(F.col(col)))


def _table_rows(spark: SparkSession, folder: str) -> DataFrame:
    """(section, year_slug, page, table_index, row_idx, header, cells) of one-table CSV files of any width."""
    path = F.col("path")
    return read_rows(spark, folder, "page_*_table_*.csv").select(
        F.regexp_extract(path, r"/([^/_]+)_[^/]*/[^/]*$", 1).alias("section"), F.regexp_extract(path, r"/[^/_]+_([^/]*)/[^/]*$", 1).alias("year_slug"),
        F.regexp_extract(path, r"page_(\d+)_table_", 1).cast("int").alias("page"), F.regexp_extract(path, r"_table_(\d+)\.csv$", 1).cast("int").alias("table_index"),
        "row_idx", "header", "cells",
    )


def read_table_cells(spark: SparkSession, folder: str) -> DataFrame:
    """(section, year_slug, page, table_index, row_idx, col_idx, text) of one-table CSV files.

    Paths are ``<section>_<year slug>/page_<p>_table_<t>.csv``. A row has as many cells as its line, whatever the other lines have.
    """
    return _table_rows(spark, folder).select("section", "year_slug", "page", "table_index", "row_idx", F.posexplode("cells").alias("col_idx", "text"))


def read_table_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """(section, year_slug, page, table_index, row_idx, col_idx, header, text): the cells below each table's header row; null headers past it."""
    cells = _table_rows(spark, folder).filter("row_idx > 0").select("section", "year_slug", "page", "table_index", (F.col("row_idx") - 1).alias("row_idx"), "header", F.posexplode("cells").alias("col_idx", "text"))
    return cells.withColumn("header", F.get("header", F.col("col_idx"))).select("section", "year_slug", "page", "table_index", "row_idx", "col_idx", "header", "text")


def read_records(spark: SparkSession, path: str, schema: str | T.StructType, multi_line: bool = True, exclude: str | None = None) -> DataFrame:
    """JSON records with their file name; ``exclude`` leaves out one file, as the merged one of a folder."""
    rows = spark.read.schema(schema).option("multiLine", multi_line).json(path).select("*", F.col("_metadata.file_name").alias("file_name"))
    return rows.filter(F.col("file_name") != exclude) if exclude else rows


def read_text_corpus(spark: SparkSession, folder: str, prefix: str, pattern: str = "*.txt", skip_prefix: str = "_") -> DataFrame:
    """(source_key, file_name, full_text) of whole text files, trimmed; invalid bytes become replacement characters."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder)
    text = lossy_text(F.col("content"))
    name = S.base_name(S.decoded(F.col("path")))
    rows = raw.select(name.alias("file_name"), S.strip(text).alias("full_text")).filter(~F.col("file_name").startswith(skip_prefix))
    return rows.select(S.source_key("file_name", prefix).alias("source_key"), "file_name", "full_text")


def lossy_text(content: Column) -> Column:
    return F.make_valid_utf8(content.cast("string"))


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """(pos, title, audio_url) of a feed's items, in order; items without an enclosure are left out."""
    schema = "title string, enclosure struct<_url string>"
    items = spark.read.format("xml").option("rowTag", "item").schema(schema).load(path).select("*", F.monotonically_increasing_id().alias("_at"))
    pos = F.row_number().over(Window.partitionBy("_f").orderBy("_at")) - 1
    numbered = items.withColumn("_f", F.col("_metadata.file_path")).withColumn("pos", pos)
    title = F.coalesce(F.nullif(S.strip("title"), F.lit("")), F.concat(F.lit("episode_"), F.col("pos").cast("string")))
    return numbered.filter("enclosure._url is not null").select("pos", title.alias("title"), F.col("enclosure._url").alias("audio_url"))


def read_survey(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_done(spark: SparkSession, path: str) -> DataFrame:
    """(key): the distinct lines of a list of finished keys."""
    return spark.read.text(path).select(S.strip("value").alias("key")).filter("key <> ''").distinct()

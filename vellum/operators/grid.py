"""Raw grids of cells to typed, headered tables.

Cells are (key columns, row_idx, col_idx, text); a missing cell of a ragged row is a row with null text. Everything is
partitioned by the table's key, so one shuffle serves the judgement and the records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.functions import scalars as S

KEY = ["doc_id", "page", "table_index"]


def axis_label(text: Column | str) -> Column:
    """Whether a cell looks like the rotated text of a chart's axis: four lines or more, most of at most two characters."""
    text = F.col(text) if isinstance(text, str) else text
    lines = F.filter(F.transform(F.split(text, "\n"), S.strip), lambda x: x != "")
    mostly_short = S.let(lines, lambda x: (F.size(x) >= 4) & (F.size(F.filter(x, lambda y: F.length(y) <= 2)) > F.size(x) * 0.6))
    return F.coalesce(F.when(line_breaks(text) >= 3, mostly_short), F.lit(False))  # most cells have one line and are not split


def line_breaks(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit("")))


def judge_tables(cells: DataFrame, key: list[str] = KEY) -> DataFrame:
    """(key, ok, reason, axis_share): whether a grid is a genuine table, and why not."""
    text = F.coalesce("text", F.lit(""))
    filled = text != ""
    stats = cells.groupBy(*key).agg(
        (F.max("row_idx") + 1).alias("rows"), (F.max("col_idx") + 1).alias("cols"),
        F.max((F.col("row_idx") == 0) & F.upper(text).contains("GRAPH")).alias("graph"),
        F.max(line_breaks(text) >= 3).alias("legend"),
        F.count_if(filled).alias("cells"), F.count_if(filled & axis_label(text)).alias("axis"),
    )
    axis_share = F.try_divide("axis", "cells")
    reason = (
        F.when(F.col("rows") < 3, "few rows").when(F.col("cols") < 2, "few columns").when(F.col("graph"), "graph header")
        .when(F.col("legend"), "legend cell").when(F.col("cells") == 0, "empty").when(axis_share > 0.25, "axis text")
    )
    return stats.select(*key, reason.isNull().alias("ok"), reason.alias("reason"), F.coalesce(axis_share, F.lit(0.0)).alias("axis_share"))


def headers(cells: DataFrame, key: list[str] = KEY) -> DataFrame:
    """(key, col_idx, header, clash): unique names of a grid's first row.

    Blank names become col_i and repeated ones name_1, name_2. ``clash`` marks a made name that another column has too.
    """
    top = cells.filter("row_idx = 0").select(*key, "col_idx", S.strip(F.coalesce("text", F.lit(""))).alias("_t"))
    named = top.withColumn("_name", F.when(F.col("_t") == "", F.concat(F.lit("col_"), F.col("col_idx").cast("string"))).otherwise(F.col("_t")))
    again = F.row_number().over(Window.partitionBy(*key, "_name").orderBy("col_idx")) - 1
    header = F.when(again > 0, F.concat("_name", F.lit("_"), again.cast("string"))).otherwise(F.col("_name"))
    out = named.withColumn("header", header)
    clash = F.count("*").over(Window.partitionBy(*key, "header")) > 1
    return out.select(*key, "col_idx", "header", clash.alias("clash"))


def grid_to_records(cells: DataFrame, key: list[str] = KEY, least_rows: int = 2) -> DataFrame:
    """(key, row_idx, col_idx, header, value) of the rows below the header.

    Short rows are filled with '', values are trimmed and lose thousands commas, empty rows are dropped, and tables with fewer
    than ``least_rows`` rows left are dropped. A table with a row longer than its header is left out: see ``overlong``.
    """
    # one column holds the key, so that one shuffle of bare cells serves all steps, whichever parts of a key are constant
    dealt = cells.select(F.struct(*key).alias("_key"), "row_idx", "col_idx", "text").repartition("_key")
    body = dealt.filter("row_idx > 0").withColumn("value", S.strip_commas(S.strip(F.coalesce("text", F.lit("")))))
    rows = body.groupBy("_key", "row_idx").agg(F.map_from_entries(F.collect_list(F.struct("col_idx", "value"))).alias("_cells"), F.bool_or(F.col("value") != "").alias("_some"), F.max("col_idx").alias("_end"))
    table = Window.partitionBy("_key")
    some = rows.filter("_some").withColumns({"_rows": F.count("*").over(table), "_most": F.max("_end").over(table)}).filter(F.col("_rows") >= least_rows)
    width = headers(dealt, ["_key"]).groupBy("_key").agg(F.array_sort(F.collect_list(F.struct("col_idx", "header"))).alias("_names"), F.max("col_idx").alias("_last"))
    good = some.join(width, "_key").filter("_most <= _last")
    cell = F.explode("_names").alias("_n")
    own = [F.col("_key")[k].alias(k) for k in key]
    return good.select(*own, "row_idx", "_cells", cell).select(*key, "row_idx", "_n.col_idx", "_n.header", F.coalesce(F.try_element_at("_cells", F.col("_n.col_idx")), F.lit("")).alias("value"))


def overlong(cells: DataFrame, key: list[str] = KEY) -> DataFrame:
    """Keys of tables in which a row is longer than the header; only they are kept back, not their whole document."""
    last = lambda cond: F.max(F.when(cond, F.col("col_idx")))
    return cells.groupBy(*key).agg(last(F.col("row_idx") == 0).alias("_h"), last(F.col("row_idx") > 0).alias("_b")).filter("_b > coalesce(_h, -1)").select(*key)


def extract_tables(cells: DataFrame, key: list[str] = KEY) -> DataFrame:
    """Records of the genuine tables alone; pages count from 1."""
    good = judge_tables(cells, key).filter("ok").select(*key)
    return grid_to_records(cells.join(good, key, "left_semi"), key)


def select_documents(docs: DataFrame, done: DataFrame, section: str | None, min_year: int = 2010) -> DataFrame:
    """Documents of a section from a start year on that are not done yet; adds section_slug."""
    picked = docs if section is None else docs.filter(F.col("section") == section)
    named = picked.withColumn("start_year", S.start_year("label")).withColumn("section_slug", F.concat_ws("_", F.lower("section"), S.label_slug("label")))
    return named.filter(F.col("start_year") >= min_year).join(done.select("section_slug"), "section_slug", "left_anti")


def table_wide(records: DataFrame, key: list[str], names: list[str]) -> DataFrame:
    """One row a record with the columns named; other headers are left out."""
    return records.groupBy(*key, "row_idx").pivot("header", names).agg(F.last("value"))

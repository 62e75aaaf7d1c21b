"""Keyed records: first per key, resume and anti-joins, nested lists, envelopes, entity chains, counters."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.functions import scalars as S
from vellum.operators.bloom import without
from vellum.operators.running import carried_last


def has_key(*cols: str) -> Column:
    """All keys present and not empty."""
    out = F.lit(True)
    for c in cols:
        out = out & (F.coalesce(F.col(c).cast("string"), F.lit("")) != "")
    return out


def first_per_key(df: DataFrame, key: str | list[str], order: list, keep_empty: bool = False) -> DataFrame:
    """The first record of each key in the order given; records without a key are dropped.

    The window is cut to its first row before the shuffle, so a key with many records sends one from each task.
    """
    keys = [key] if isinstance(key, str) else key
    rows = df if keep_empty else df.filter(has_key(*keys))
    return rows.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_rn = 1").drop("_rn")


def carry_forward(df: DataFrame, col: str, by: list[str], order: list, name: str | None = None) -> DataFrame:
    """The last value that is not null up to each row. A group may hold all rows; it is carried on from slice to slice."""
    return carried_last(df, col, by, order, name or col)


def first_n(df: DataFrame, n: int, order: list) -> DataFrame:
    return df.orderBy(*order).limit(n)


def todo(items: DataFrame, done: DataFrame, key: str, limit: int | None = None, order: list | None = None) -> DataFrame:
    """Items that are not done yet. A limit is taken before what is done is removed, so a resumed run adds nothing to it.

    Of a long list of finished keys a Bloom filter is made, and only items that it finds are shuffled.
    """
    if limit is not None:
        items = first_n(items, limit, order or [key])
    return without(items, done, key)


def append_new(new: DataFrame, existing: DataFrame, key: str, order: list | None = None, filtered: bool = True) -> DataFrame:
    """Rows of ``new`` to insert: the first of each key that is not there yet. Unless ``filtered`` is off, new keys are told by a Bloom filter."""
    first = first_per_key(new, key, order or [key], keep_empty=True)
    return without(first, existing, key) if filtered else first.join(existing.select(key), key, "left_anti")


def explode_keep_parent(df: DataFrame, list_col: str, parent_cols: list[str], name: str = "entry") -> DataFrame:
    """One row a list item; a parent without items keeps one row with a null item."""
    return df.select(*parent_cols, F.explode_outer(list_col).alias(name))


def flatten_entries(df: DataFrame, list_col: str, parent_cols: list[str]) -> DataFrame:
    """(parent columns, record): maps of parent and entry merged; an entry's value wins over the parent's."""
    rows = explode_keep_parent(df, list_col, parent_cols, "_entry")
    parent = F.map_from_arrays(F.array(*(F.lit(c) for c in parent_cols)), F.array(*(F.col(c).cast("string") for c in parent_cols)))
    entry = F.coalesce(F.col("_entry"), F.expr("cast(map() as map<string,string>)"))
    merged = F.map_concat(F.map_filter(parent, lambda k, _: ~F.map_contains_key(entry, k)), entry)
    return rows.select(*parent_cols, merged.alias("record"))


def merge_histories(people: DataFrame, list_col: str = "WorkHistory", parent_cols: tuple[str, ...] = ("GCFAId", "URL", "Name")) -> DataFrame:
    """Work histories as flat records, one a history entry, people without entries kept."""
    return flatten_entries(people, list_col, list(parent_cols))


def entry_total(df: DataFrame, list_col: str) -> Column:
    return F.sum(F.coalesce(F.size(F.col(list_col)), F.lit(0)))


def decode_escaped_json(df: DataFrame, payload_col: str, schema: str | T.StructType, every_entity: bool = True) -> DataFrame:
    """One row a record of an escaped JSON array; a payload that is no array gives no rows."""
    text = S.unescape_all(F.col(payload_col)) if every_entity else S.unescape(payload_col)
    schema = schema.simpleString() if isinstance(schema, T.StructType) else f"struct<{schema}>"
    items = F.from_json(F.when(F.ltrim(text).startswith("["), text), F.lit(f"array<{schema}>"), {"mode": "PERMISSIVE"})
    return df.select(*(c for c in df.columns if c != payload_col), F.explode(items).alias("_r")).select(*(c for c in df.columns if c != payload_col), "_r.*")


def concat_pages(pages: DataFrame, data_col: str = "data", keys: tuple[str, ...] = (), total_col: str | None = None, length: int = 100, first_page: int = 1) -> DataFrame:
    """(keys..., page, pos, item): records of the pages' data.

    With ``total_col`` a key's pages end as a reader of pages of ``length`` would: at the first page without data, with an empty list, or whose
    records reach that page's total (a null total is 0). Later pages are left out. Only sizes of lists are shuffled to find that page.
    """
    rows = pages
    if total_col:
        reached = (F.col("page") - first_page) * length + F.coalesce(F.size(data_col), F.lit(0)) >= F.coalesce(F.col(total_col), F.lit(0))
        over = reached | F.coalesce(F.size(data_col), F.lit(0)).eqNullSafe(0)
        named = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)] or [F.lit(0).alias("_k0")]
        last = pages.filter(over).groupBy(*named).agg(F.min("page").alias("_last"))
        same = reduce(and_, (F.col(f"_k{i}").eqNullSafe(F.col(k)) for i, k in enumerate(keys))) if keys else F.col("_k0") == F.lit(0)
        rows = pages.join(last if keys else F.broadcast(last), same, "left").filter("_last is null or page <= _last")  # without keys it is one row
    return rows.select(*keys, "page", F.posexplode(data_col).alias("pos", "item"))


def page_completeness(pages: DataFrame, data_col: str = "data", total_col: str = "recordsTotal", by: tuple[str, ...] = ()) -> DataFrame:
    """(expected, got, complete) of paged envelopes."""
    got = F.coalesce(F.sum(F.coalesce(F.size(F.col(data_col)), F.lit(0))), F.lit(0)).cast("bigint")
    out = pages.groupBy(*by).agg(F.max(total_col).cast("bigint").alias("expected"), got.alias("got"))
    return out.withColumn("complete", F.coalesce(F.col("got") >= F.col("expected"), F.lit(False)))


def explode_items(df: DataFrame, col: str, item_schema: str) -> DataFrame:
    """(page columns, pos, item, last_page) of collection envelopes ``{items, pagination}`` in JSON text."""
    shape = f"struct<items: array<struct<{item_schema}>>, pagination: struct<nextPage: boolean, nextPageOffset: bigint>>"
    parsed = df.withColumn("_e", F.from_json(col, F.lit(shape)))
    more = F.coalesce(F.col("_e.pagination.nextPage"), F.lit(False)) & (F.coalesce(F.col("_e.pagination.nextPageOffset"), F.lit(0)) != 0)
    rest = [c for c in df.columns if c != col]
    return parsed.select(*rest, (~more).alias("last_page"), F.posexplode_outer("_e.items").alias("pos", "item"))


def tag(df: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Adds a dimension's columns to each record."""
    return df.join(dim, key, "left")


def church_urls(histories: DataFrame, url_col: str = "Appointment_URL", mark: str = "church?", limit: int | None = None) -> DataFrame:
    """Distinct sorted links that name a church."""
    urls = histories.filter(has_key(url_col) & F.col(url_col).contains(mark)).select(F.col(url_col).alias("url")).distinct().orderBy("url")
    return urls.limit(limit) if limit else urls


def entity_chain(people: DataFrame, histories: DataFrame, churches: DataFrame, person_key: str = "GCFAId", church_key: str = "ChurchId", url_col: str = "Appointment_URL") -> DataFrame:
    """People with their history entries and the church that each entry's link names; nothing is lost on the left."""
    entries = histories.withColumn(church_key, S.id_from_url(url_col, "church"))
    return people.join(entries, person_key, "left").join(churches, church_key, "left")


def mark_failed(df: DataFrame, error_col: str = "Error") -> DataFrame:
    """Adds ``failed``; failed records stay in the table."""
    return df.withColumn("failed", has_key(error_col))


def run_counts(df: DataFrame, list_col: str | None = None, error_col: str | None = None) -> DataFrame:
    """(metric, n): entities, entries and errors of a run."""
    metrics = {"entities": F.count("*")}
    if list_col:
        metrics["entries"] = entry_total(df, list_col)
    if error_col:
        metrics["errors"] = F.count_if(has_key(error_col))
    row = df.agg(*(F.coalesce(v, F.lit(0)).cast("bigint").alias(k) for k, v in metrics.items()))
    return row.unpivot([], list(metrics), "metric", "n")


def flatten_record(df: DataFrame, list_mode: str = "all", url_base: str | None = None, key: str = "GCFAId", url_col: str = "URL") -> DataFrame:
    """Every column as text: lists by their labels, null as '', and a link made from the key."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType):
            names = [n for n in ("label", "Name") if n in f.dataType.elementType.names]
            out.append(S.list_text(f.name, tuple(names), list_mode).alias(f.name))
        elif isinstance(f.dataType, T.ArrayType):
            items = F.transform(F.col(f.name).cast("array<string>"), lambda x: x)
            text = F.array_join(items, "; ") if list_mode == "all" else F.coalesce(F.try_element_at(items, F.lit(1)), F.lit(""))
            out.append(F.when(F.col(f.name).isNull(), "").when(F.size(f.name) == 0, "[]").otherwise(text).alias(f.name))
        elif isinstance(f.dataType, (T.StructType, T.MapType)):
            out.append(F.coalesce(F.to_json(f.name), F.lit("")).alias(f.name))
        else:
            out.append(S.or_empty(F.col(f.name).cast("string")).alias(f.name))
    if url_base:
        out.append(S.or_empty(S.entity_url(key, url_base)).alias(url_col))
    return df.select(*out)

"""Records whose keys differ from row to row, as VARIANT.

Nested values stay what they are until they are written as text. The keys of all rows and the type of each come from one aggregation with
partial sums in the tasks; only that schema reaches the driver, since it names the columns of a table.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.functions import scalars as S


def parse_records(df: DataFrame, text_col: str, record: str = "record") -> DataFrame:
    """Adds the JSON text's value. Text that is no JSON, null, or an object that repeats a key gives null; the row stays."""
    return df.withColumn(record, F.try_parse_json(text_col))


def as_records(df: DataFrame, record: str = "record", keep: tuple[str, ...] = (), drop_null: bool = True) -> DataFrame:
    """(keep..., record): the other columns of a row as one record, so that tables of any columns and types can be united.

    A null column has no key in the record, or with ``drop_null=False`` the key with JSON's null.
    """
    whole = F.to_variant_object(F.struct(*(c for c in df.columns if c not in keep)))
    if drop_null:
        whole = F.to_variant_object(F.map_filter(entries(whole), lambda _, v: ~F.is_variant_null(v)))
    return df.select(*keep, whole.alias(record))


def unite_records(*parts: DataFrame, record: str = "record") -> DataFrame:
    """(record): rows of tables whose columns and column types may differ."""
    made = [as_records(p, record) for p in parts]
    out = made[0]
    for part in made[1:]:
        out = out.union(part)
    return out


def _variant(df: DataFrame, col: str) -> Column:
    """A VARIANT, map or struct column as VARIANT."""
    return F.col(col) if isinstance(df.schema[col].dataType, T.VariantType) else F.to_variant_object(col)


def entries(record: Column | str) -> Column:
    """Map of a record's keys to VARIANT values; null for what is no object."""
    return F.try_variant_get(F.col(record) if isinstance(record, str) else record, "$", "map<string,variant>")


def found_types(df: DataFrame, record: str = "record") -> T.StructType:
    """Keys of all records with the type that holds every value found: VARIANT where values differ in kind, void where all are null.

    No records give no keys. The state is one schema a task, which grows with distinct keys at every depth, not with rows.
    """
    value = _variant(df, record)
    ddl = df.agg(F.schema_of_variant_agg(value)).first()[0]
    if ddl == "VARIANT":  # something is no object, which is seldom: only then are kinds of values looked at row by row
        ddl = df.agg(F.schema_of_variant_agg(F.when(entries(value).isNotNull(), value))).first()[0]
    if not ddl.startswith("OBJECT<"):
        return T.StructType()
    return T.DataType.fromDDL(re.sub(r"(`(?:[^`]|``)*`)|OBJECT<", lambda m: m[1] or "STRUCT<", ddl))


def column_order(found: T.StructType, lead: tuple[str, ...] = ()) -> list[str]:
    """Leading columns, found or not, then all other keys in order."""
    return [*lead, *sorted(set(found.names) - set(lead))]


def as_text(value: Column, mode: str = "all", fields: tuple[str, ...] = ("label", "Name")) -> Column:
    """A VARIANT as a table shows it: null and no value are '', a list its items joined by '; ', an object its JSON.

    With ``mode="first"`` only a list's first item counts. An item that is an object shows its first non-empty field, else its JSON; null items
    are left out. An empty list is '[]'.
    """

    def item(x: Column) -> Column:
        names = (F.nullif(F.try_element_at(entries(x), F.lit(f)).try_cast("string"), F.lit("")) for f in fields)
        return F.coalesce(*names, x.try_cast("string"))

    def shown(items: Column) -> Column:
        text = F.transform(items, item)
        some = F.array_join(text, "; ") if mode == "all" else F.coalesce(F.get(text, F.lit(0)), F.lit(""))
        return F.when(F.size(items) == 0, "[]").otherwise(some)

    return S.let(F.try_variant_get(value, "$", "array<variant>"), lambda items: F.when(items.isNotNull(), shown(items)).otherwise(S.or_empty(value.try_cast("string"))))


def text_table(df: DataFrame, record: str = "record", lead: tuple[str, ...] = (), keep: tuple[str, ...] = (), mode: str = "all") -> DataFrame:
    """(keep..., one text column a key): the union of all records' keys, leading columns first; a missing value is ''.

    What is no object is a row of ''. Keys that differ in case only are columns of their own.
    """
    found = found_types(df, record)
    listed = {f.name for f in found.fields if isinstance(f.dataType, (T.ArrayType, T.VariantType))}  # the others have no list in any row
    rows = df.select(*keep, entries(_variant(df, record)).alias("_m"))

    def column(c: str) -> Column:
        value = F.try_element_at("_m", F.lit(c))
        return (as_text(value, mode) if c in listed else S.or_empty(value.try_cast("string"))).alias(c)

    return rows.select(*keep, *(column(c) for c in column_order(found, lead)))


def _storable(kind: T.DataType) -> T.DataType:
    """A type found, with text for what was always null and VARIANT for objects that never had a key."""
    if isinstance(kind, T.NullType):
        return T.StringType()
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_storable(kind.elementType))
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _storable(f.dataType)) for f in kind.fields]) if kind.fields else T.VariantType()
    return kind


def typed_table(df: DataFrame, record: str = "record", lead: tuple[str, ...] = (), keep: tuple[str, ...] = ()) -> DataFrame:
    """(keep..., one column a key) in the types found, lists and objects included; null where a record has no such key.

    A key whose values differ in kind stays VARIANT, as does an object that is empty everywhere; what is null everywhere is text.
    """
    found = found_types(df, record)
    kinds = {f.name: _storable(f.dataType) for f in found.fields}
    rows = df.select(*keep, entries(_variant(df, record)).alias("_m"))

    def column(c: str) -> Column:
        value, kind = F.try_element_at("_m", F.lit(c)), kinds.get(c, T.StringType())
        return (F.when(~F.is_variant_null(value), value) if isinstance(kind, T.VariantType) else value.try_cast(kind)).alias(c)

    return rows.select(*keep, *(column(c) for c in column_order(found, lead)))


def key_counts(df: DataFrame, record: str = "record", by: tuple[str, ...] = ()) -> DataFrame:
    """(by..., key, n, filled): records that have a key, and those in which it isn't null; counted before anything is shuffled."""
    rows = df.select(*by, F.explode(entries(_variant(df, record))).alias("key", "_v"))
    return rows.groupBy(*by, "key").agg(F.count("*").alias("n"), F.count_if(~F.is_variant_null("_v")).alias("filled"))

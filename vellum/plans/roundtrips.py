"""Queries that write tables, texts, feeds and records with the sinks, read them back with the readers, and their SQL.

Everything is written to the shared folder under a new name. The rows come from the shared tables, so the work grows with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.functions import scalars as S
from vellum.operators import grid, records
from vellum.operators import open_records as records_open
from vellum.session import new_path, table
from vellum.sources import readers, sinks
from vellum.streaming.ingest import ingest_available, ingest_json

TABLE_KEY = ["section", "year_slug", "page", "table_index"]


def text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _customers(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer")


# ---- tables


def _nation_tables(spark, sf_dir) -> DataFrame:
    """A table of customers for each nation and segment: a header row, then cells with commas, quotes and line breaks."""
    place = [F.concat(F.lit("n"), text("c_nationkey")).alias("section"), F.lit("2020-21").alias("year_slug"), F.col("c_nationkey").alias("page"), (F.length("c_mktsegment") % 2).alias("table_index")]
    rows = _customers(spark, sf_dir).select(*place, F.col("c_custkey").alias("row_idx"), text("c_custkey").alias("a"), F.concat("c_mktsegment", F.lit(',\n"x" '), text("c_nationkey")).alias("b"), F.format_number(F.col("c_custkey") * 1000, 0).alias("c"))
    heads = rows.select(*TABLE_KEY).distinct().select(*TABLE_KEY, F.lit(-1).cast("bigint").alias("row_idx"), F.lit("Id").alias("a"), F.lit("Segment").alias("b"), F.lit("").alias("c"))
    return heads.unionByName(rows)


def table_files(spark, sf_dir):
    """One CSV a table, read back as cells under their headers, as records, and wide again."""
    path = new_path(spark, "table-files")
    sinks.write_table_files(_nation_tables(spark, sf_dir), path, ["a", "b", "c"])
    cells = readers.read_table_cells(spark, path)
    wide = grid.table_wide(grid.grid_to_records(cells, TABLE_KEY), TABLE_KEY, ["Id", "Segment", "col_2"])
    return wide.select(*TABLE_KEY, "Id", "Segment", F.col("col_2").alias("thousands"))


def table_corpus(spark, sf_dir):
    """Counts of the corpus that the same files make."""
    path = new_path(spark, "table-files")
    sinks.write_table_files(_nation_tables(spark, sf_dir), path, ["a", "b", "c"])
    cells = readers.read_table_corpus(spark, path)
    return cells.groupBy(*TABLE_KEY, "header").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"), F.max("row_idx").cast("bigint").alias("last_row"))


def wide_table_files(spark, sf_dir):
    """Tables of 3 to 40 columns, whose later rows are shorter or longer than their header, read back cell by cell."""
    path = new_path(spark, "wide-tables")
    n = F.col("c_custkey") % 38 + 3  # columns of the table
    place = [F.lit("w").alias("section"), F.lit("2020-21").alias("year_slug"), (F.col("c_custkey") % 38).cast("int").alias("page"), F.lit(0).alias("table_index")]
    cells = F.transform(F.sequence(F.lit(1).cast("bigint"), n + F.col("c_custkey") % 5 - 2), lambda i: F.concat(text("c_custkey"), F.lit(',"\n'), text(i)))
    rows = _customers(spark, sf_dir).select(*place, F.col("c_custkey").alias("row_idx"), cells.alias("cells"))
    heads = _customers(spark, sf_dir).select(*place, F.lit(-1).cast("bigint").alias("row_idx"), F.transform(F.sequence(F.lit(1).cast("bigint"), n), lambda i: F.concat(F.lit("h"), text(i))).alias("cells")).distinct()
    sinks.write_table_files(heads.unionByName(rows), path, "cells")
    return readers.read_table_corpus(spark, path).select("page", "row_idx", "col_idx", "header", "text")


def table_cells(spark, sf_dir):
    """Cells written by section and year; one section is read back."""
    path = new_path(spark, "cells")
    rows = _nation_tables(spark, sf_dir).withColumn("section", F.when(F.col("page") % 2 == 0, "even").otherwise("odd"))
    cells = rows.filter("row_idx >= 0").select(*TABLE_KEY, F.col("row_idx"), F.posexplode(F.array("a", "c")).alias("col_idx", "text"))
    sinks.write_tables(cells, path)
    back = spark.read.parquet(path).filter("section = 'odd'")
    return back.select("page", "table_index", "row_idx", "col_idx", "text")


# ---- texts, feeds and records


def text_files(spark, sf_dir):
    """Each supplier's text in a file of its own, read as whole stripped texts."""
    path = new_path(spark, "texts")
    body = F.concat(F.lit(" \t"), F.col("s_name"), F.lit("\n\nbalance "), text(F.floor("s_acctbal")), F.lit("\u00a0\n"))
    sinks.write_text_files(table(spark, sf_dir, "supplier").select(body.alias("value")), path)
    got = readers.read_text_corpus(spark, path, "suppliers")
    return got.select("full_text", F.col("source_key").startswith("file://suppliers/part-").alias("keyed"), (F.col("source_key") == F.concat(F.lit("file://suppliers/"), "file_name")).alias("named"))


def feed_items(spark, sf_dir):
    """A feed for each block of a hundred customers; items without a recording are left out, and some have no title."""
    path = new_path(spark, "feeds")
    key = F.col("c_custkey")
    url = F.when(key % 4 > 0, F.concat(F.lit("http://a/"), text(key), F.lit(".mp3")))
    title = F.when(key % 5 > 0, F.concat(F.lit("Talk "), text(key))).when(key % 2 == 0, F.lit(" \n "))
    items = _customers(spark, sf_dir).select(F.floor(key / 100).alias("feed"), key.alias("o"), title.alias("title"), F.when(url.isNotNull(), F.struct(url.alias("_url"))).alias("enclosure"))
    ordered = items.repartition("feed").sortWithinPartitions("feed", "o").drop("o")
    ordered.write.partitionBy("feed").option("rootTag", "channel").option("rowTag", "item").format("xml").save(path)
    return readers.read_feed(spark, f"{path}/*").select(F.col("pos").cast("int").alias("pos"), "title", "audio_url")


def record_files(spark, sf_dir):
    """Customers as JSON records with a link from their key, some without a key."""
    path = new_path(spark, "records")
    rows = _customers(spark, sf_dir).select(F.when(F.col("c_custkey") % 6 > 0, text("c_custkey")).otherwise("").alias("GCFAId"), F.col("c_name").alias("name"))
    sinks.write_json(rows, path, "GCFAId", "https://b/p?id=")
    return readers.read_records(spark, path, "GCFAId string, name string, URL string", multi_line=False, exclude="all.json").select(F.col("GCFAId").alias("id"), "name", F.col("URL").alias("url"))


def record_arrays(spark, sf_dir):
    """Arrays of up to a hundred suppliers as JSON files, tagged with the nation that their key names."""
    path = new_path(spark, "arrays")
    item = F.struct(text("s_suppkey").alias("id"), F.col("s_nationkey").alias("nation"))
    arrays = table(spark, sf_dir, "supplier").groupBy(F.floor(F.col("s_suppkey") / 100).alias("g")).agg(F.to_json(F.array_sort(F.collect_list(item))).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)
    rows = readers.read_records(spark, path, "id string, nation int")
    nations = table(spark, sf_dir, "nation").filter("n_nationkey % 5 > 0").select(F.col("n_nationkey").alias("nation"), F.col("n_name").alias("nation_name"))
    return records.tag(rows, nations, "nation").select("id", "nation_name")


def union_csv(spark, sf_dir):
    """Customers and suppliers as maps of differing keys in one CSV: the key first, the other keys in order."""
    path = new_path(spark, "union")

    def record(key: Column, **fields: Column) -> Column:
        return F.create_map(F.lit("Id"), key, *(x for k, v in fields.items() for x in (F.lit(k), v))).alias("record")

    a = _customers(spark, sf_dir).select(record(F.concat(F.lit("c"), text("c_custkey")), Segment=F.col("c_mktsegment"), Name=F.concat(F.lit('say "'), "c_name", F.lit('",'))))
    b = table(spark, sf_dir, "supplier").select(record(F.concat(F.lit("s"), text("s_suppkey")), Nation=text("s_nationkey")))
    sinks.write_union_csv(a.union(b), path, lead=("Id",))
    back = spark.read.option("header", True).option("escape", '"').option("nullValue", "").csv(path)
    if back.columns != ["Id", "Name", "Nation", "Segment"]:
        raise ValueError(f"columns {back.columns}")
    return back.select(F.col("Id").alias("id"), *(S.or_empty(c).alias(c.lower()) for c in ("Name", "Nation", "Segment")))


def union_nested_csv(spark, sf_dir):
    """JSON texts of customers, suppliers and orders, whose keys, lists and objects differ, in one CSV of the union of their keys."""
    path = new_path(spark, "open")
    part = F.col("o_orderkey")
    move = lambda label=None, name=None, n=None: F.struct(F.lit(label).cast("string").alias("label"), F.lit(name).cast("string").alias("Name"), F.lit(n).cast("bigint").alias("n"))
    moves = F.array(move(F.concat(F.lit("to "), text(part))), move("", F.concat(F.lit("n"), text(part))), move(n=part))
    texts = [
        _customers(spark, sf_dir).select(F.to_json(F.struct(F.concat(F.lit("c"), text("c_custkey")).alias("Id"), F.col("c_nationkey").alias("Nation"), F.struct(F.col("c_mktsegment").alias("seg")).alias("Facts")))),
        table(spark, sf_dir, "supplier").select(F.to_json(F.struct(F.concat(F.lit("s"), text("s_suppkey")).alias("Id"), F.array(text("s_nationkey"), F.col("s_name")).alias("Nation")))),
        table(spark, sf_dir, "orders").select(F.to_json(F.struct(F.concat(F.lit("o"), text(part)).alias("Id"), F.when(part % 3 > 0, moves).otherwise(F.array()).alias("Moves"), F.when(part % 2 == 0, F.col("o_orderstatus")).alias("status")))),
    ]
    rows = texts[0].toDF("j").union(texts[1]).union(texts[2])
    sinks.write_union_csv(records_open.parse_records(rows, "j"), path, lead=("Id",))
    back = spark.read.option("header", True).option("escape", '"').option("nullValue", "").csv(path)
    if back.columns != ["Id", "Facts", "Moves", "Nation", "status"]:
        raise ValueError(f"columns {back.columns}")
    return back.select(F.col("Id").alias("id"), *(S.or_empty(c).alias(c.lower()) for c in back.columns[1:]))


def united_records(spark, sf_dir):
    """Tables of differing columns as records in one Parquet dataset, then columns in the types found: lists and objects survive."""
    path = new_path(spark, "united")
    customers = _customers(spark, sf_dir).select(F.col("c_custkey").alias("key"), F.struct(F.col("c_mktsegment").alias("seg"), F.col("c_nationkey").alias("nation")).alias("facts"), F.col("c_name").alias("any"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), F.when(F.col("o_orderkey") % 2 == 0, F.array("o_custkey", "o_orderkey")).alias("links"), F.col("o_custkey").alias("any"))
    records_open.unite_records(customers, orders).write.parquet(path)
    wide = records_open.typed_table(spark.read.parquet(path), lead=("key",))
    return wide.select("key", "facts.seg", F.col("facts.nation").cast("int").alias("nation"), F.element_at("links", 1).alias("first_link"), F.col("any").cast("string").alias("any_text"))


def record_keys(spark, sf_dir):
    """How many events of each type and user have which key in their JSON."""
    extra = F.concat(F.lit('{"u'), text(F.col("user_id") % 7), F.lit('": '), F.when(F.col("event_id") % 2 == 0, "null").otherwise("[1]"), F.lit(', "p": '), "props", F.lit("}"))
    rows = table(spark, sf_dir, "events").select("event_type", extra.alias("j"))
    got = records_open.key_counts(records_open.parse_records(rows, "j"), by=("event_type",))
    return got.select("event_type", "key", "n", "filled")


def paged_records(spark, sf_dir):
    """Conversations as pages of three turns, read until a page is empty or the total is reached."""
    page, conv = F.floor(F.col("turn") / 3), F.col("conv_id")
    pages = table(spark, sf_dir, "conversations").groupBy("conv_id", page.alias("page")).agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    total = F.when(conv % 4 == 0, 3).when(conv % 4 == 1, 5).when(conv % 4 == 2, 100)
    shown = pages.select("conv_id", "page", F.when((conv % 5 == 0) & (F.col("page") == 1), F.array().cast("array<int>")).otherwise(F.col("turns").cast("array<int>")).alias("data"), total.alias("recordsTotal"))
    got = records.concat_pages(shown, keys=("conv_id",), total_col="recordsTotal", length=3, first_page=0)
    return got.select("conv_id", F.col("page").cast("int").alias("page"), F.col("pos").cast("int").alias("pos"), F.col("item").alias("turn"))


def section_files(spark, sf_dir):
    """Suppliers and parts as sections of their own, and all of them in one dataset."""
    path = new_path(spark, "sections")
    suppliers = table(spark, sf_dir, "supplier").select(text("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    parts = table(spark, sf_dir, "part").select(text("p_partkey").alias("id"), F.col("p_brand").alias("brand"))
    sinks.write_sections({"suppliers": suppliers, "parts": parts}, path)
    both = spark.read.schema("record string, section string").json(f"{path}/all").select("section", F.from_json("record", "id string, name string, brand string").alias("r"))
    alone = spark.read.schema("id string, name string").json(f"{path}/suppliers").select(F.lit("alone").alias("section"), "id", "name", F.lit(None).cast("string").alias("brand"))
    return both.select("section", "r.id", "r.name", "r.brand").union(alone)


def text_table(spark, sf_dir):
    path = new_path(spark, "text-table")
    sinks.write_text_table(table(spark, sf_dir, "documents").select("doc_id", S.clean_transcript(S.or_empty("text")).alias("clean")), path)
    return readers.read_survey(spark, path).select("doc_id", F.length("clean").alias("chars"))


def finished_keys(spark, sf_dir):
    """Orders that a list of finished links does not name; the list has blanks, empty lines and repeats."""
    path = new_path(spark, "done")
    link = F.concat(F.lit("http://o/"), text("o_orderkey"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", link.alias("key"))
    lines = orders.filter("o_orderkey % 3 = 0").select(F.explode(F.array(F.concat(F.lit("\t"), "key", F.lit(" ")), "key", F.lit("  "))).alias("value"))
    lines.write.text(path)
    return records.todo(orders, readers.read_done(spark, path), "key").select("o_orderkey")


# ---- envelopes and names


def collection_items(spark, sf_dir):
    """Pages of a collection: recordings by the first of three places that name one, and their file names."""
    key = F.col("o_orderkey")
    k = text(key)
    first = F.when(key % 4 == 0, F.concat(F.lit("http://a/x%20"), k, F.lit("+y.mp3?d=1"))).otherwise("http://a/none")
    second = F.when(key % 4 == 1, F.concat(F.lit("http://b/"), k, F.lit(".mp3/more")))
    body = F.when(key % 4 == 2, F.concat(F.lit("<a href='https://c/"), k, F.lit(".mp3'>x</a>")))
    item = F.struct(F.concat(F.lit(" Talk (no. "), k, F.lit(")")).alias("title"), first.alias("audioAssetUrl"), second.alias("audioUrl"), body.alias("body"))
    orders = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct(key.alias("o"), item.alias("i")))).alias("items"))
    envelope = F.to_json(F.struct(F.transform("items", lambda x: x["i"]).alias("items"), F.struct((F.col("o_custkey") % 3 > 0).alias("nextPage"), (F.col("o_custkey") % 2).alias("nextPageOffset")).alias("pagination")))
    rows = records.explode_items(orders.select("o_custkey", envelope.alias("body")), "body", "title string, audioAssetUrl string, audioUrl string, body string")
    url = S.audio_url("item.audioAssetUrl", "item.audioUrl", "item.body")
    named = rows.select("o_custkey", "last_page", F.col("pos").cast("int").alias("pos"), url.alias("url"), F.col("item.title").alias("title"))
    return named.select("o_custkey", "last_page", "pos", "url", F.when(F.col("url").isNotNull(), S.file_from_url("url", "title")).alias("file"))


def iso_file_dates(spark, sf_dir):
    d, key = "o_orderdate", F.col("o_orderkey")
    stem = F.when(key % 4 == 0, F.concat(F.lit("talk "), F.date_format(d, "yyyy-MM-dd"), F.lit(" x"))).when(key % 4 == 1, F.date_format(d, "yyyy.MM.dd")).when(key % 4 == 2, F.lit("2020-13-40")).otherwise(F.concat(F.lit("a_"), F.date_format(d, "yyyy-MM-dd")))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.date_format(S.file_date(stem, S.ISO_FILE_DATES)["date"], "yyyy-MM-dd").alias("date"))


def entity_links(spark, sf_dir):
    key = F.when(F.col("s_suppkey") % 3 == 0, "").when(F.col("s_suppkey") % 3 == 1, text("s_suppkey"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", S.entity_url(key, "https://b/c?church=").alias("url"))


def wrapped_labels(spark, sf_dir):
    label = F.concat_ws(" ", "p_name", "p_brand", "p_type")
    return table(spark, sf_dir, "part").select("p_partkey", S.wrap(label, 18).alias("label"))


def first_record(spark, sf_dir):
    return records.first_n(_customers(spark, sf_dir).select("c_custkey", "c_name"), 1, [F.desc("c_custkey")])


# ---- ingest


def append_twice(spark, sf_dir):
    """Links appended in two runs that overlap and repeat themselves: every key once, with the counts of both runs."""
    path = new_path(spark, "appended")
    rows = table(spark, sf_dir, "orders").select(F.concat(F.lit("u"), text(F.col("o_orderkey") % 5000)).alias("url"), "o_orderkey")
    one = sinks.append_new_to(path, rows.filter("o_orderkey % 2 = 0"), "url", ["url", "o_orderkey"])
    two = sinks.append_new_to(path, rows, "url", ["url", "o_orderkey"])
    kept = spark.read.parquet(path)
    counts = [F.lit(n).cast("bigint").alias(c) for c, n in (("imported_1", one["imported"]), ("skipped_1", one["skipped"]), ("imported_2", two["imported"]), ("skipped_2", two["skipped"]))]
    return kept.select("url", "o_orderkey", *counts)


def ingest_records(spark, sf_dir):
    """Events as JSON files, ingested in two runs of which the second finds new files with old keys in them."""
    folder, check, target = (new_path(spark, n) for n in ("incoming", "progress", "ingested"))
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    schema = "event_id bigint, user_id bigint, event_type string"
    for part in (events.filter("event_id % 3 > 0"), events.filter("event_id % 3 < 2")):
        part.write.mode("append").json(folder)
        ingest_json(spark, folder, check, target, schema, "event_id").awaitTermination()
    return spark.read.parquet(target).select("event_id", "user_id", "event_type")


def ingest_texts(spark, sf_dir):
    """Suppliers' texts as files, ingested in two runs; a third finds nothing new."""
    folder, check, target = (new_path(spark, n) for n in ("incoming", "progress", "ingested"))
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", F.concat(F.lit("\n"), "s_name", F.lit("\n\tline two\n")).alias("value"))
    for part in (rows.filter("s_suppkey % 2 = 0"), rows.filter("s_suppkey % 2 = 1"), None):
        if part is not None:
            sinks.write_text_files(part.select("value"), folder, "append")
        ingest_available(spark, folder, check, target, "suppliers").awaitTermination()
    return spark.read.parquet(target).select("full_text")


QUERIES = {f.__name__: f for f in (
    table_files, table_corpus, wide_table_files, table_cells, text_files, feed_items, record_files, record_arrays, union_csv, union_nested_csv, united_records, record_keys, paged_records, section_files, text_table, finished_keys,
    collection_items, iso_file_dates, entity_links, wrapped_labels, first_record, append_twice, ingest_records, ingest_texts,
)}

_TABLES = """SELECT 'n' || c_nationkey AS section, '2020-21' AS year_slug, c_nationkey AS page, CAST(length(c_mktsegment) % 2 AS INT) AS table_index, c_custkey AS k, CAST(c_custkey AS VARCHAR) AS a,
  c_mktsegment || ',' || chr(10) || '"x" ' || c_nationkey AS b, format('{:,}', c_custkey * 1000) AS c FROM customer"""

ORACLE_SQL = {
    "table_files": f"""
WITH t AS ({_TABLES}), n AS (SELECT section, table_index FROM t GROUP BY 1, 2 HAVING count(*) >= 2)
SELECT section, year_slug, page, table_index, a AS "Id", b AS "Segment", replace(c, ',', '') AS thousands FROM t JOIN n USING (section, table_index)""",
    "table_corpus": f"""
WITH t AS ({_TABLES}), u AS (SELECT section, year_slug, page, table_index, unnest(['Id', 'Segment', '']) AS header, unnest([a, b, c]) AS text FROM t)
SELECT section, year_slug, page, table_index, header, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars, count(*) - 1 AS last_row FROM u GROUP BY ALL""",
    "wide_table_files": """
WITH t AS (SELECT CAST(c_custkey % 38 AS INT) AS page, c_custkey AS k, CAST(row_number() OVER (PARTITION BY c_custkey % 38 ORDER BY c_custkey) - 1 AS INT) AS row_idx, c_custkey % 38 + 3 AS n FROM customer),
c AS (SELECT page, k, row_idx, n, unnest(range(n + k % 5 - 2)) AS i FROM t)
SELECT page, row_idx, CAST(i AS INT) AS col_idx, CASE WHEN i < n THEN 'h' || (i + 1) END AS header, k || ',"' || chr(10) || (i + 1) AS text FROM c""",
    "table_cells": f"SELECT page, table_index, k AS row_idx, unnest([0, 1]) AS col_idx, unnest([a, c]) AS text FROM ({_TABLES}) WHERE page % 2 = 1",
    "text_files": "SELECT s_name || chr(10) || chr(10) || 'balance ' || CAST(floor(s_acctbal) AS BIGINT) AS full_text, true AS keyed, true AS named FROM supplier",
    "feed_items": """
WITH i AS (SELECT c_custkey AS k, CAST(row_number() OVER (PARTITION BY c_custkey // 100 ORDER BY c_custkey) - 1 AS INT) AS pos FROM customer)
SELECT pos, CASE WHEN k % 5 > 0 THEN 'Talk ' || k ELSE 'episode_' || pos END AS title, 'http://a/' || k || '.mp3' AS audio_url FROM i WHERE k % 4 > 0""",
    "record_files": "SELECT CASE WHEN c_custkey % 6 > 0 THEN CAST(c_custkey AS VARCHAR) ELSE '' END AS id, c_name AS name, CASE WHEN c_custkey % 6 > 0 THEN 'https://b/p?id=' || c_custkey END AS url FROM customer",
    "record_arrays": "SELECT CAST(s_suppkey AS VARCHAR) AS id, n_name AS nation_name FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey AND n_nationkey % 5 > 0",
    "union_csv": """
SELECT 'c' || c_custkey AS id, 'say "' || c_name || '",' AS name, '' AS nation, c_mktsegment AS segment FROM customer
UNION ALL SELECT 's' || s_suppkey, '', CAST(s_nationkey AS VARCHAR), '' FROM supplier""",
    "union_nested_csv": """
SELECT 'c' || c_custkey AS id, '{"seg":"' || c_mktsegment || '"}' AS facts, '' AS moves, CAST(c_nationkey AS VARCHAR) AS nation, '' AS status FROM customer
UNION ALL SELECT 's' || s_suppkey, '', '', s_nationkey || '; ' || s_name, '' FROM supplier
UNION ALL SELECT 'o' || o_orderkey, '', CASE WHEN o_orderkey % 3 = 0 THEN '[]' ELSE 'to ' || o_orderkey || '; n' || o_orderkey || '; {"n":' || o_orderkey || '}' END, '',
  CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus ELSE '' END FROM orders""",
    "united_records": """
SELECT c_custkey AS key, c_mktsegment AS seg, c_nationkey AS nation, NULL::BIGINT AS first_link, c_name AS any_text FROM customer
UNION ALL SELECT o_orderkey, NULL, NULL, CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END, CAST(o_custkey AS VARCHAR) FROM orders""",
    "record_keys": """
SELECT event_type, 'u' || (user_id % 7) AS key, count(*) AS n, count(*) FILTER (event_id % 2 <> 0) AS filled FROM events GROUP BY 1, 2
UNION ALL SELECT event_type, 'p', count(*), count(*) FROM events GROUP BY 1""",
    "paged_records": """
WITH t AS (SELECT conv_id, turn // 3 AS page, turn, CASE conv_id % 4 WHEN 0 THEN 3 WHEN 1 THEN 5 WHEN 2 THEN 100 ELSE 0 END AS total, conv_id % 5 = 0 AND turn // 3 = 1 AS gone FROM conversations),
p AS (SELECT conv_id, page, any_value(gone) AS gone, any_value(page * 3) + CASE WHEN any_value(gone) THEN 0 ELSE count(*) END >= any_value(total) AS reached FROM t GROUP BY 1, 2),
s AS (SELECT conv_id, page, sum(CASE WHEN gone OR reached THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM p)
SELECT conv_id, CAST(page AS INT) AS page, CAST(row_number() OVER (PARTITION BY conv_id, page ORDER BY turn) - 1 AS INT) AS pos, CAST(turn AS INT) AS turn
FROM t JOIN s USING (conv_id, page) WHERE NOT gone AND coalesce(before, 0) = 0""",
    "section_files": """
SELECT 'suppliers' AS section, CAST(s_suppkey AS VARCHAR) AS id, s_name AS name, NULL::VARCHAR AS brand FROM supplier
UNION ALL SELECT 'alone', CAST(s_suppkey AS VARCHAR), s_name, NULL FROM supplier UNION ALL SELECT 'parts', CAST(p_partkey AS VARCHAR), NULL, p_brand FROM part""",
    "text_table": r"""
WITH a AS (SELECT doc_id, replace(regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), 'Speaker \d+\s*:?\s*', '', 'g'), '(?s)\[.*?\]', '', 'g'), '(?s)\(.*?\)', '', 'g'), '♪', '') AS t FROM documents)
SELECT doc_id, CAST(length(trim(regexp_replace(regexp_replace(regexp_replace(t, '#[^\n]*', '', 'g'), '^\s*[-–—]\s*', ''), '\s+', ' ', 'g'))) AS INT) AS chars FROM a""",
    "finished_keys": "SELECT o_orderkey FROM orders WHERE o_orderkey % 3 > 0",
    "collection_items": """
SELECT o_custkey, NOT (o_custkey % 3 > 0 AND o_custkey % 2 <> 0) AS last_page, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS INT) AS pos,
  CASE o_orderkey % 4 WHEN 0 THEN 'http://a/x%20' || o_orderkey || '+y.mp3?d=1' WHEN 1 THEN 'http://b/' || o_orderkey || '.mp3/more' WHEN 2 THEN 'https://c/' || o_orderkey || '.mp3' END AS url,
  CASE o_orderkey % 4 WHEN 0 THEN 'x ' || o_orderkey || '+y.mp3' WHEN 1 THEN 'Talk_no._' || o_orderkey || '.mp3' WHEN 2 THEN o_orderkey || '.mp3' END AS file FROM orders""",
    "iso_file_dates": "SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 2 THEN strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') END AS date FROM orders",
    "entity_links": "SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 1 THEN 'https://b/c?church=' || s_suppkey END AS url FROM supplier",
    "wrapped_labels": """
SELECT p_partkey, list_reduce(list_filter(string_split(p_name || ' ' || p_brand || ' ' || p_type, ' '), lambda x: x <> ''),
  lambda a, w: CASE WHEN length(regexp_extract(a, '[^\\n]*$')) + 1 + length(w) < 18 THEN a || ' ' || w ELSE a || chr(10) || w END) AS label FROM part""",
    "first_record": "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey DESC LIMIT 1",
    "append_twice": """
WITH r AS (SELECT 'u' || (o_orderkey % 5000) AS url, o_orderkey AS k FROM orders), a AS (SELECT url, min(k) AS k FROM r WHERE k % 2 = 0 GROUP BY 1),
b AS (SELECT url, min(k) AS k FROM r WHERE url NOT IN (SELECT url FROM a) GROUP BY 1), n AS (SELECT (SELECT count(*) FROM a) AS a, (SELECT count(*) FROM b) AS b)
SELECT url, k AS o_orderkey, n.a AS imported_1, (SELECT count(*) FROM r WHERE k % 2 = 0) - n.a AS skipped_1, n.b AS imported_2, (SELECT count(*) FROM r) - n.b AS skipped_2
FROM (SELECT * FROM a UNION ALL SELECT * FROM b), n""",
    "ingest_records": "SELECT event_id, user_id, event_type FROM events",
    "ingest_texts": "SELECT s_name || chr(10) || chr(9) || 'line two' AS full_text FROM supplier",
}

"""Registered queries by name: each takes a session and a folder of tables.

The test tables stand in for the engine's own inputs: parts for respondents with code columns, orders for dated
records, documents for grids and transcripts. Counts are 64-bit and ratios are rounded to four places, as in the SQL of
``vellum.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vellum.functions import scalars as S
from vellum.functions.recode import recode
from vellum.operators import county, grid, page_local, pages, records, survey
from vellum.plans import derived, oracle, roundtrips
from vellum.session import table

__all__ = ["ORACLE_SQL", "QUERIES"]


def r4(c: Column | str) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 4)


def big(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")


# ---- survey analytics

#: Rules over three code columns of part, in the order in which they are tried.
PART_RULES = [
    ("p_size", 1, "Size One"), ("p_size", 2, "Size Two"), ("p_size", 3, "Other Size"), ("brand", 1, "Brand One"), ("brand", 2, "Brand Two"),
    ("brand", 3, "Brand Three"), ("brand", 25, "Other Brand"), ("kind", 1, "Economy"), ("kind", 2, "Large"), ("kind", 3, "Medium"), ("kind", 90, "Other Type"),
]


def coded_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = {"ECONOMY": 1, "LARGE": 2, "MEDIUM": 3, "PROMO": 90}
    kind = F.coalesce(*(F.when(F.col("p_type") == k, v) for k, v in kinds.items()))
    brand = F.regexp_extract("p_brand", r"(\d+)", 1).cast("int")
    return table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice", "p_type", brand.alias("brand"), kind.alias("kind"))


def recode_first_match(spark, sf_dir):
    rows = coded_parts(spark, sf_dir).withColumn("t", recode(PART_RULES))
    return rows.select("p_partkey", F.col("t.label").alias("trad"), F.col("t.ord").alias("ord"))


def topk_labels(spark, sf_dir):
    rows = coded_parts(spark, sf_dir).withColumn("t", recode(PART_RULES)).select("p_partkey", "t.label", "t.ord")
    sold = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("p_partkey")).groupBy("p_partkey").agg(F.count("*").alias("c"))
    weighted = rows.join(sold, "p_partkey").filter("label is not null and not startswith(label, 'Other')")
    top = weighted.groupBy("label").agg(F.sum("c").alias("n"), F.min("ord").alias("o")).orderBy(F.desc("n"), "o").limit(5)
    return top.select("label", big("n").alias("n"), F.row_number().over(Window.orderBy(F.desc("n"), "o")).alias("rank"))


def bucket_share_in_group(spark, sf_dir):
    """Shares of balance buckets among the customers of the three nations with most orders, ordered by their top bucket."""
    customers = table(spark, sf_dir, "customer").withColumn("nation", F.concat(F.lit("N"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0")))
    ordered = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")).join(customers.select("c_custkey", "nation"), "c_custkey")
    kept = survey.keep_labels(customers, survey.top_labels(ordered, "nation", 3), "nation")
    bucketed = kept.withColumn("b", S.bucket("c_acctbal", [0, 2000, 4000, 6000, 8000, float("inf")], ["0-2k", "2-4k", "4-6k", "6-8k", "8k+"]))
    shares = survey.share(bucketed.select("nation", F.col("b.label").alias("bucket")), ["nation", "bucket"], ["nation"])
    topped = survey.spread_value(shares, ["nation"], F.col("bucket") == "8k+", "pct", "pct_top")
    ordered_by = survey.order_by_stat(topped, "nation", "pct_top", ascending=False)
    return ordered_by.select("nation", "bucket", big("n").alias("n"), r4("pct").alias("pct"), r4("pct_top").alias("pct_top"), "ord")


def mode_mean_by_group(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    stats = parts.groupBy("p_brand").agg(F.avg("p_size").alias("mean"), F.mode("p_size", True).cast("double").alias("mode"))
    return survey.longer(stats, ["p_brand"], ["mean", "mode"], "stat", "value").select("p_brand", "stat", r4("value").alias("value"))


def order_lines(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("year"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_quantity", "l_tax", "l_returnflag")
    return lines.join(orders, "o_orderkey")


def weighted_share_by_period(spark, sf_dir):
    rows = order_lines(spark, sf_dir).withColumn("period", S.period("year", {"1995-1997": (1995, 1997), "1999-2001": (1999, 2001)})).filter("period is not null")
    small = F.when(F.col("l_quantity") > 2, (F.col("l_quantity") <= 20).cast("int"))
    out = rows.groupBy("o_orderstatus", "period").agg(survey.weighted_mean(small, 1 + F.col("l_tax")).alias("share"), F.count(small).alias("n"))
    return out.select("o_orderstatus", "period", r4("share").alias("share"), big("n").alias("n"))


def weighted_flag_mean(spark, sf_dir):
    rows = order_lines(spark, sf_dir)
    flag = S.cohort_flag("year", 1996, 1998)
    out = rows.groupBy("l_returnflag").agg(survey.weighted_mean(flag, F.col("l_quantity")).alias("share"), F.count("*").alias("n"))
    return out.select("l_returnflag", r4("share").alias("share"), big("n").alias("n"))


def weighted_quantiles(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", S.years_left(F.col("l_quantity").cast("int") + 17).alias("left"), (1 + F.col("l_tax")).alias("w"))
    wide = survey.weighted_quantiles(rows, ["l_returnflag"], "left", "w", [0.3, 0.4, 0.5], ["year_30", "year_40", "year_50"])
    return survey.longer(wide, ["l_returnflag"], ["year_30", "year_40", "year_50"], "threshold", "years").select("l_returnflag", S.relabel("threshold", {"year_30": "30%", "year_40": "40%", "year_50": "50%"}).alias("threshold"), r4("years").alias("years"))


def stat_join_back(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_retailprice")
    mean = parts.groupBy("p_type").agg(F.avg("p_retailprice").alias("mean"))
    joined = survey.order_by_stat(survey.stat_back(parts, ["p_type"], mean), "p_type", "mean")
    return joined.select("p_partkey", "p_type", r4("mean").alias("mean"), "ord", S.percent_text(F.col("p_retailprice") / 10000).alias("pct"))


# ---- keyed records


def first_per_key(spark, sf_dir):
    return records.first_per_key(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"]).select("user_id", "event_id", "event_type", r4("value").alias("value"))


def carry_forward(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("heading", F.when(F.col("event_type") == "signup", F.concat(F.lit("s"), F.col("event_id").cast("string"))))
    return records.carry_forward(events, "heading", ["user_id"], ["ts", "event_id"]).select("event_id", "user_id", "heading")


def todo_minus_done(spark, sf_dir):
    return records.todo(table(spark, sf_dir, "documents").select("doc_id", "source"), table(spark, sf_dir, "labels"), "doc_id")


def limit_then_anti(spark, sf_dir):
    return records.todo(table(spark, sf_dir, "documents").select("doc_id", "lang"), table(spark, sf_dir, "labels"), "doc_id", limit=100)


def explode_keep_parent(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").groupBy(F.col("conv_id").alias("doc_id")).agg(F.array_sort(F.collect_list(F.col("turn"))).alias("turns"))
    parents = table(spark, sf_dir, "documents").select("doc_id", "lang").join(turns, "doc_id", "left")
    rows = records.explode_keep_parent(parents, "turns", ["doc_id", "lang"], "turn")
    return rows.select("doc_id", "lang", big("turn").alias("turn"))


def union_missing_columns(spark, sf_dir):
    a = table(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), r4("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("segment"))
    b = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), r4("s_acctbal").alias("acctbal"), F.col("s_nationkey").alias("nation"))
    return survey.union_all(a, b, missing=True)


def nested_flatten_join(spark, sf_dir):
    item = F.struct(F.col("turn").alias("at"), F.when(F.col("turn") % 2 == 0, F.concat("role", F.lit("-"), F.col("turn").cast("string"))).alias("label"), F.col("role").alias("Name"))
    people = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(item)).alias("parts"))
    return people.select("conv_id", S.list_text("parts").alias("every"), S.list_text("parts", mode="first").alias("first"))


def json_field_default(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", F.concat(F.lit("["), F.replace("props", F.lit('"'), F.lit("&quot;")), F.lit("]")).alias("payload"))
    got = records.decode_escaped_json(events, "payload", "k bigint, missing string")
    return got.select("event_id", "k", S.or_default("missing", "none").alias("missing"))


def map_to_wide(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").groupBy("o_custkey", "o_orderstatus").agg(F.count("*").alias("n"))
    counts = orders.groupBy("o_custkey").agg(F.map_from_entries(F.collect_list(F.struct("o_orderstatus", "n"))).alias("facts"))
    return survey.facts_wide(counts, "facts", ["F", "O", "P"]).select("o_custkey", *(F.coalesce(big(c), F.lit(0)).alias(f"n_{c.lower()}") for c in ("F", "O", "P")))


def run_counters(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.collect_list("turn").alias("turns"), F.max(F.when(F.length("text") < 20, F.lit("short"))).alias("Error"))
    return records.run_counts(turns, "turns", "Error")


def entity_chain(spark, sf_dir):
    """Customers with their orders and the supplier that each order's link names."""
    people = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("GCFAId"), "c_name")
    link = F.concat(F.lit("/x?church="), (F.col("o_orderkey") % 100).cast("string"))
    histories = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("GCFAId"), "o_orderkey", link.alias("Appointment_URL"))
    churches = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("ChurchId"), "s_name")
    return records.entity_chain(people, histories, churches).groupBy("GCFAId").agg(F.count("o_orderkey").alias("entries"), F.countDistinct("s_name").alias("churches"), F.min("s_name").alias("first_church"))


def distinct_urls(spark, sf_dir):
    histories = table(spark, sf_dir, "orders").select(F.concat(F.when(F.col("o_orderkey") % 3 == 0, F.lit("church?church=")).otherwise(F.lit("other?id=")), (F.col("o_custkey") % 200).cast("string")).alias("Appointment_URL"))
    return records.church_urls(histories).select("url", S.id_from_url("url", "church").alias("church_id"))


def page_completeness(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    envelopes = turns.groupBy("conv_id", F.floor(F.col("turn") / 2).alias("page")).agg(F.collect_list("turn").alias("data"), (F.max("turn") + 1).alias("recordsTotal"))
    out = records.page_completeness(envelopes, by=("conv_id",))
    return out.select("conv_id", "expected", "got", "complete")


def idempotent_append(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(S.source_key(F.concat(F.col("doc_id").cast("string"), F.lit(".txt")), "documents").alias("url"), "doc_id", "lang")
    existing = docs.filter("doc_id % 3 = 0")
    new = records.append_new(docs.union(docs), existing, "url", ["url", "doc_id"])
    return existing.union(records.append_new(new.union(docs), existing.union(new), "url", ["url", "doc_id"])).union(new)


# ---- text


def slug_names(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("key"), F.md5(S.slug(F.coalesce("text", F.lit("")), keep_dot=True)).alias("slug"))
    parts = table(spark, sf_dir, "part").select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("key"), S.slug(F.concat(F.lit("\t"), "p_name", F.lit("\u00a0("), "p_brand", F.lit(")\n"))).alias("slug"))
    return docs.union(parts)


def _stem() -> Column:
    d = "o_orderdate"
    forms = [
        F.concat(F.lit("Sunday "), F.date_format(d, "M-d-yyyy")), F.concat(F.lit("talk "), F.date_format(d, "MM.dd.yy")), F.concat(F.lit("x "), F.date_format(d, "M-d-yy")),
        F.concat(F.lit("a "), F.date_format(d, "MMddyy")), F.concat(F.lit("b "), F.date_format(d, "MMddyyyy")), F.concat(F.lit("Kettering_Bap_"), F.date_format(d, "MM-dd-yyyy")), F.lit("bad 13-45-2020 of"),
    ]
    pick = F.col("o_orderkey") % len(forms)
    return F.coalesce(*(F.when(pick == i, f) for i, f in enumerate(forms)))


def filename_dates(spark, sf_dir):
    stems = table(spark, sf_dir, "orders").select("o_orderkey", _stem().alias("stem"))
    got = stems.withColumn("d", S.file_date("stem"))
    return got.select("o_orderkey", F.date_format("d.date", "yyyy-MM-dd").alias("date"), F.col("d.pattern").alias("pattern"), S.file_title("stem", F.col("d.date")).alias("title"))


def date_ranges(spark, sf_dir):
    d = "o_orderdate"
    start = F.date_format(d, "M/d/yyyy")
    text = F.when(F.col("o_orderkey") % 4 == 0, F.concat(start, F.lit(" - Present"))).when(F.col("o_orderkey") % 4 == 1, start)
    text = text.when(F.col("o_orderkey") % 4 == 2, F.date_format(d, "M-d-yyyy")).otherwise(F.concat(start, F.lit(" - "), F.date_format(F.date_add(d, 40), "M/d/yyyy")))
    blanks = F.replace(text, F.lit("/"), F.lit(" /\n"))  # blanks around the parts, and ends that are empty
    text = F.when(F.col("o_orderkey") % 5 == 0, blanks).when(F.col("o_orderkey") % 20 == 1, F.concat(text, F.lit(" -"))).when(F.col("o_orderkey") % 20 == 9, F.concat(F.lit("- "), text)).otherwise(text)
    rows = table(spark, sf_dir, "orders").select("o_orderkey", S.date_range(text).alias("r"))
    return rows.select("o_orderkey", F.col("r.start").alias("start_date"), F.col("r.end").alias("end_date"))


def text_dates(spark, sf_dir):
    d = "o_orderdate"
    text = F.when(F.col("o_orderkey") % 4 == 0, F.date_format(d, "MMMM d, yyyy")).when(F.col("o_orderkey") % 4 == 1, F.date_format(d, "MMM. d, yyyy"))
    text = text.when(F.col("o_orderkey") % 4 == 2, F.date_format(d, "MMMM yyyy")).otherwise(F.lit(" Advent "))
    text = F.when(F.col("o_orderkey") % 3 == 0, F.replace(text, F.lit(" "), F.lit("\n  "))).otherwise(text)  # white space inside
    spaced = F.concat(F.lit("\n\t"), text, F.lit("\u00a0\n"))
    return table(spark, sf_dir, "orders").select("o_orderkey", S.text_date(spaced)["raw"].alias("date"))


def numeric_text(spark, sf_dir):
    grouped = F.format_number("o_totalprice", 2)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", S.strip_commas(grouped).alias("plain"), S.strip_commas(F.concat(grouped, F.lit(" km"))).alias("kept"),
        S.count_text(F.when(F.col("o_orderkey") % 5 > 0, F.format_number("o_custkey", 0))).alias("counted"), S.fact_value(F.concat(F.lit("$"), grouped)).alias("fact"),
        F.lpad(F.col("o_custkey").cast("string"), 5, "0").alias("code"),
    )


def transcript_clean(spark, sf_dir):
    dressed = F.concat(F.lit("- Speaker 1: [intro\nmusic] "), F.replace("text", F.lit("\n"), F.lit("\n♪ (aside) # sung line\n")))
    text = F.when(F.col("doc_id") % 2 == 0, dressed).otherwise(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(S.clean_transcript(text)).alias("clean_md5"))


def parse_move_text(spark, sf_dir):
    name = F.concat(F.lit("Person "), F.col("o_custkey").cast("string"), F.lit(","))
    text = F.concat(F.lit("\n"), name, F.lit("\n\t to Place "), (F.col("o_orderkey") % 50).cast("string"), F.when(F.col("o_orderkey") % 3 > 0, F.concat(F.lit(", from Town "), F.col("o_orderstatus"))).otherwise(""))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", S.parse_move(text, F.when(F.col("o_orderkey") % 7 > 0, name)).alias("m"))
    return rows.select("o_orderkey", F.col("m.name").alias("person"), F.col("m.to").alias("to_place"), F.col("m.from").alias("from_place"))


# ---- pages


def url_parts(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", S.absolutise(S.url_path("url"), "https://base.example").alias("link"), F.try_element_at(S.query_params("url"), F.lit("page")).alias("page_param"),
        S.id_from_url("url", "page").alias("page_no"), S.base_name(S.decoded(S.url_path("url"))).alias("name"),
    )


def page_title_h1(spark, sf_dir):
    return pages.page_names(pages.html_nodes(table(spark, sf_dir, "pages"), ("h1", "title"), ("h1", "title"))).select("page_id", "name", "heading")


def page_links(spark, sf_dir):
    links = page_local.page_links(table(spark, sf_dir, "pages"))
    return links.select("page_id", F.col("pos").cast("int").alias("pos"), "href")


def page_list_items(spark, sf_dir):
    items = page_local.dated_list(table(spark, sf_dir, "pages"), head="title", item="li", parent=None)
    return items.select("page_id", F.col("pos").cast("int").alias("pos"), F.col("date").alias("heading"), "text")


# ---- grids


def doc_grid(spark, sf_dir) -> DataFrame:
    """Documents as grids: a line is a row, a word is a cell; ten documents in a folder of pages."""
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("row_idx", "line"))
    cells = lines.select("doc_id", "row_idx", F.posexplode(F.split("line", " ")).alias("col_idx", "text"))
    return cells.select((F.col("doc_id") % 10).alias("doc"), F.col("doc_id").alias("page"), F.lit(0).alias("table_index"), "row_idx", "col_idx", "text")


GRID_KEY = ["doc", "page", "table_index"]


def grid_is_table(spark, sf_dir):
    return grid.judge_tables(doc_grid(spark, sf_dir), GRID_KEY).select("page", "ok", F.coalesce("reason", F.lit("")).alias("reason"))


def headed_grid(spark, sf_dir) -> DataFrame:
    """Two thirds of the documents with their widest line as a header above all lines; the others keep their first line, which may be too short."""
    rows = F.transform(F.split("text", "\n"), lambda line: F.split(line, " "))
    widest = F.expr("filter(rows, r -> size(r) = array_max(transform(rows, x -> size(x))))[0]")
    whole = F.when(F.col("doc_id") % 3 == 0, F.col("rows")).otherwise(F.concat(F.array(widest), F.col("rows")))
    lines = table(spark, sf_dir, "documents").select("doc_id", rows.alias("rows")).select("doc_id", F.posexplode(whole).alias("row_idx", "words"))
    cells = lines.select("doc_id", "row_idx", F.posexplode("words").alias("col_idx", "text"))
    return cells.select((F.col("doc_id") % 10).alias("doc"), F.col("doc_id").alias("page"), F.lit(0).alias("table_index"), "row_idx", "col_idx", "text")


def grid_headers_records(spark, sf_dir):
    out = grid.grid_to_records(headed_grid(spark, sf_dir), GRID_KEY)
    return out.groupBy("page").agg(F.countDistinct("row_idx").alias("n_rows"), F.count("*").alias("n_cells"), F.countDistinct("header").alias("n_headers"), F.count_if(F.col("value") == "").alias("n_blank"))


# ---- areas


def diversity_by_area(spark, sf_dir):
    out = county.county_diversity(table(spark, sf_dir, "customer").withColumn("one", F.lit(1)), "c_nationkey", "c_mktsegment", "one")
    return out.select("c_nationkey", big("groups").alias("groups"), big("total").alias("total"), *(r4(c).alias(c) for c in ("largest_share", "shannon", "simpson")))


def nation_orders(spark, sf_dir) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice", F.year("o_orderdate").alias("year"))
    return orders.join(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey").withColumn("fips", county.fips("c_nationkey"))


def change_between_waves(spark, sf_dir):
    rows = nation_orders(spark, sf_dir)
    wave = lambda y: rows.filter(F.col("year") == y).groupBy("fips").agg(F.count("*").alias("n"))
    return county.wave_change(wave(1996), wave(2000), ["fips"], "n").select("fips", "before", "after", r4("change").alias("change"))


def _nation_counts(spark, sf_dir) -> DataFrame:
    customers = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count("*").alias("population"))
    return nation_orders(spark, sf_dir).groupBy("c_nationkey").agg(F.count("*").alias("n")).join(customers, "c_nationkey")


def regression_residuals(spark, sf_dir):
    out = county.regress_residuals(_nation_counts(spark, sf_dir), "n", "population")
    return out.select("c_nationkey", *(r4(c).alias(c) for c in ("slope", "intercept", "residual")))


def adjusted_rate(spark, sf_dir):
    counts = _nation_counts(spark, sf_dir).withColumn("n", F.when(F.col("c_nationkey") % 5 == 0, -9).otherwise(F.col("n"))).join(table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey"), "c_nationkey")
    factors = table(spark, sf_dir, "region").filter("r_regionkey <> 2").select(F.col("r_regionkey").alias("n_regionkey"), (1 + F.col("r_regionkey") / 10).alias("factor"))
    return county.adjusted_rate(counts, factors, "n_regionkey", "n", "population").select("c_nationkey", r4("rate").alias("rate"), r4("adjusted").alias("adjusted"))


QUERIES = {f.__name__: f for f in (
    bucket_share_in_group, recode_first_match, topk_labels, mode_mean_by_group, weighted_share_by_period, weighted_flag_mean, weighted_quantiles, stat_join_back,
    first_per_key, carry_forward, todo_minus_done, limit_then_anti, explode_keep_parent, union_missing_columns, nested_flatten_join, json_field_default, map_to_wide,
    run_counters, entity_chain, distinct_urls, page_completeness, idempotent_append, slug_names, filename_dates, date_ranges, text_dates, numeric_text, transcript_clean,
    parse_move_text, url_parts, page_title_h1, page_links, page_list_items, grid_is_table, grid_headers_records, diversity_by_area, change_between_waves,
    regression_residuals, adjusted_rate,
)}

QUERIES |= derived.QUERIES | roundtrips.QUERIES
ORACLE_SQL = oracle.ORACLE_SQL | derived.ORACLE_SQL | roundtrips.ORACLE_SQL

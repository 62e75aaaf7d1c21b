"""Queries over survey rows, pages and lists that are derived from the shared tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.functions.recode import TRADITION_CODES
from vellum.operators import grid, page_local, pages
from vellum.plans import reports
from vellum.session import table, written

COLUMNS = list(TRADITION_CODES)


def r4(c: str) -> Column:
    return F.round(F.col(c), 4).alias(c)


# ---- survey rows: an order is a respondent


def respondents(spark, sf_dir) -> DataFrame:
    key = F.col("o_orderkey")
    code = (F.floor(key / 12) % 10 + 1).cast("int")
    codes = [F.when(key % 12 == i, code).alias(c) for i, c in enumerate(COLUMNS[:-1])]
    birth = F.when(key % 50 != 0, (1915 + (F.col("o_custkey") * 7 + key) % 95).cast("int"))
    return table(spark, sf_dir, "orders").select(
        (2006 + key % 19).cast("int").alias("year"), birth.alias("birthyr"), (0.5 + (key % 7) / 4).alias("weight"), *codes,
        F.when((key % 12 == 11) | (key % 5 == 0), 1).alias(COLUMNS[-1]),
    )


def _report(maker):
    def query(spark, sf_dir):
        people = reports.recoded(respondents(spark, sf_dir))
        return maker(people, reports.top_traditions(people))

    return query


def survey_age_shares(spark, sf_dir):
    return _report(reports.age_shares)(spark, sf_dir).select("trad", "age_bucket", "n", r4("pct"), r4("pct75"), "ord")


def survey_age_stats(spark, sf_dir):
    return _report(reports.age_stats)(spark, sf_dir).select("trad", "stat", r4("age"), "n", "ord")


def survey_young_shares(spark, sf_dir):
    return _report(reports.young_shares)(spark, sf_dir).select("period", "trad", r4("pct_18_40"), "n_eff", "ord")


def survey_years_left(spark, sf_dir):
    return _report(reports.years_left)(spark, sf_dir).select("trad", "threshold", r4("death_year"), "ord")


def survey_boomers(spark, sf_dir):
    return _report(reports.boomer_shares)(spark, sf_dir).select("trad", r4("pct_boomer"), "n_eff", "ord")


# ---- pages


def _nodes(html: DataFrame, texts: tuple[str, ...] | None = None, tags: tuple[str, ...] | None = None) -> DataFrame:
    """Elements of the pages, parsed once and written, for queries that read them several times."""
    return written(pages.html_nodes(html, texts, tags), "nodes")


def _text(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.replace(F.replace(F.replace(c.cast("string"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def _joined(rows: DataFrame, by: str, order: str, piece: Column) -> DataFrame:
    """Pieces of each page in order; a page is one customer's orders, or up to a hundred of a nation's suppliers."""
    parts = rows.select((F.col(by) if by != "s_nationkey" else F.col(by).cast("bigint") * 1_000_000_000 + F.floor(F.col(order) / 100)).cast("bigint").alias("page_id"), F.struct(F.col(order).alias("o"), piece.alias("p")).alias("x"))
    return parts.groupBy("page_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["p"]), "").alias("html"))


def _pages(body: DataFrame, head: Column | str = "", foot: Column | str = "") -> DataFrame:
    cover = lambda x: F.lit(x) if isinstance(x, str) else x
    return body.select("page_id", F.concat(F.lit("http://pages/"), F.col("page_id").cast("string")).alias("url"), F.concat(cover(head), F.col("html"), cover(foot)).alias("html"))


def _history_pages(spark, sf_dir) -> DataFrame:
    key, d = F.col("o_orderkey").cast("string"), "o_orderdate"
    dates = F.concat(F.date_format(d, "M/d/yyyy"), F.when(F.col("o_orderkey") % 2 == 0, F.lit(" - Present")).otherwise(F.concat(F.lit(" - "), F.date_format(F.date_add(d, 9), "M/d/yyyy"))))
    piece = F.concat(F.lit("<tr><td><a href='/c?church="), key, F.lit("'>Place "), key, F.lit("</a><td>"), dates, F.lit("<td><a href='http://x/"), key, F.lit("'>chart</a>"))
    body = _joined(table(spark, sf_dir, "orders"), "o_custkey", "o_orderkey", piece)
    return _pages(body, "<table><thead><tr><th>Appointment<th>Dates<th>View Charts</thead><tbody>", "</tbody></table>")


def page_histories(spark, sf_dir):
    rows = page_local.html_tables(_history_pages(spark, sf_dir), links=True, base="https://b")
    get = lambda k: F.try_element_at("row", F.lit(k))
    return rows.select("page_id", "row_idx", get("Appointment").alias("place"), get("Appointment_URL").alias("link"), get("StartDate").alias("start_date"), get("EndDate").alias("end_date"), get("View Charts_URL").alias("chart"), F.size("row").alias("n_fields"))


def page_tables(spark, sf_dir):
    rows = page_local.html_tables(_history_pages(spark, sf_dir))
    return rows.select("page_id", "row_idx", F.try_element_at("row", F.lit("Dates")).alias("dates"), F.size("row").alias("n_fields"))


def _supplier_rows(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "supplier").withColumn("cents", F.round(F.col("s_acctbal") * 100).cast("bigint"))


def page_sections(spark, sf_dir):
    piece = F.concat(F.lit("<tr><td><a href='/s"), F.col("s_suppkey").cast("string"), F.lit("'>"), _text("s_name"), F.lit("</a><td>x"))
    body = _joined(_supplier_rows(spark, sf_dir), "s_nationkey", "s_suppkey", piece)
    html = _pages(body, "<div><h2>Buyers</h2><table><tr><td><tr><td><a href='/no'>no</a></table></div><div><h2>All Suppliers here</h2><table><tr><th>Name", "</table></div>")
    return pages.section_links(_nodes(html, ("h2", "a")), "suppliers", "http://b").select("page_id", F.col("pos").cast("int").alias("pos"), "name", "url")


def page_facts(spark, sf_dir):
    cell = F.concat(F.lit("<td>"), F.when(F.col("s_suppkey") % 3 > 0, F.format_number("cents", 0)).otherwise(""), F.lit("</td>"))
    piece = F.concat(F.lit("<tr><td><a href='/s"), F.col("s_suppkey").cast("string"), F.lit("'>"), _text("s_name"), F.lit("</a></td>"), F.repeat(cell, F.when(F.col("s_suppkey") % 4 > 0, 8).otherwise(7)), F.lit("</tr>"))
    html = _pages(_joined(_supplier_rows(spark, sf_dir), "s_nationkey", "s_suppkey", piece), "<table><tr><th>h</tr>", "</table>")
    return pages.fact_table(_nodes(html, ("td", "th", "a"), ("table", "tr", "td", "th", "a")), [f"c{i}" for i in range(8)]).select("page_id", F.col("row_idx").cast("int").alias("row_idx"), "name", "url", "c0", "c7")


def page_options(spark, sf_dir):
    piece = F.concat(F.lit("<option value='"), F.when(F.col("s_suppkey") % 5 > 0, F.col("s_suppkey").cast("string")).otherwise(""), F.lit("'>"), _text("s_name"), F.lit(" (S)"))
    html = _pages(_joined(_supplier_rows(spark, sf_dir), "s_nationkey", "s_suppkey", piece), "<select id='second'><option value='0'>no</select><select id='first'>", "</select>")
    return pages.select_options(_nodes(html, ("option",), ("select", "option")), ["first", "second"])


def page_labelled_rows(spark, sf_dir):
    piece = F.concat(F.lit("<tr>"), F.when(F.col("s_suppkey") % 6 > 0, F.concat(F.lit("<td data-label='Name'><a href='/n'>"), _text("s_name"), F.lit("</a>"))).otherwise(""), F.lit("<td data-label='\nCity '>\n<b>no</b>\n\t"), F.when(F.col("s_suppkey") % 7 > 0, F.concat(F.lit("Town "), F.col("s_suppkey").cast("string"), F.lit("\n"))).otherwise(""), F.lit("</td></tr>"))
    html = _pages(_joined(_supplier_rows(spark, sf_dir), "s_nationkey", "s_suppkey", piece), "<table>", "</table>")
    return pages.labelled_cells(_nodes(html, ("td", "th", "a"), ("tr", "td", "th", "a")), {"Name": "name", "City": "city"}, "Name", "City").select("page_id", "name", "city", "url")


def page_cards(spark, sf_dir):
    key = F.col("s_suppkey")
    year = F.when(key % 2 == 0, F.concat(F.lit(" ("), (2000 + key % 25).cast("string"), F.lit(")"))).otherwise("")
    html = F.concat(
        F.lit("<title>"), _text("s_name"), F.lit(" - UMData</title>"), F.when(key % 3 > 0, F.concat(F.lit("<h1> The "), _text("s_name"), F.lit("\nmore</h1>"))).otherwise(""), F.lit("<div class='card'><div>Quick Facts"), year,
        F.lit("</div><ul><li>Balance: <span>$"), F.format_number("cents", 0), F.lit("</span><li>Nation <span>"), F.col("s_nationkey").cast("string"), F.lit("</span><li><span></span></ul></div>"), F.when(key % 4 == 0, "<table id='hci-download'></table>").otherwise(""),
    )
    rows = _supplier_rows(spark, sf_dir).select(key.alias("page_id"), F.lit("u").alias("url"), html.alias("html"))
    got = pages.church_pages(_nodes(rows))
    return got.select("page_id", "name", "year", "flag", F.try_element_at("facts", F.lit("Balance")).alias("balance"), F.try_element_at("facts", F.lit("Nation")).alias("nation"), F.size("facts").alias("n_facts"))


def _sermons(spark, sf_dir, head: Column, line: tuple[str, str], foot: str) -> DataFrame:
    lines = F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: F.concat(F.lit(line[0]), _text(x), F.lit(line[1])))
    docs = table(spark, sf_dir, "documents")
    return docs.select(F.col("doc_id").alias("page_id"), F.concat(F.lit("http://d/"), F.col("doc_id").cast("string")).alias("url"), F.concat(head, F.array_join(lines, ""), F.lit(foot)).alias("html"))


def _sermon_result(df: DataFrame) -> DataFrame:
    return df.select("url", "title", "date", "scripture", "speaker", F.md5("full_text").alias("text_md5"))


def page_sermons_header(spark, sf_dir):
    key = F.col("doc_id").cast("string")
    head = F.concat(F.lit("<div class='post-single-sermon'><div class='post-single-sermon-header'><h2>Talk "), key, F.lit("</h2><div class='date'>\n\t March 5,\n 2021\u00a0\n</div><strong>Speaker: X</strong><strong>John "), key, F.lit("</strong><a rel='tag' href='#'>"), _text(F.coalesce("source", F.lit(""))), F.lit("</a></div>"))
    html = _sermons(spark, sf_dir, head, ("<p>", "</p>"), "</div>")
    return _sermon_result(page_local.sermon_pages(html, "header"))


def page_sermons_article(spark, sf_dir):
    key = F.col("doc_id").cast("string")
    head = F.concat(F.lit("<article class='post tag-news tag-"), F.when(F.col("doc_id") % 2 == 0, "mary-ann").otherwise("solo"), F.lit("'><h1 class='entry-title'>Talk "), key, F.lit("</h1>"), F.when(F.col("doc_id") % 3 == 0, "<time>\n January  2,\t2020\t</time>").otherwise("<time datetime='2020-01-02T00:00'>x</time>"), F.lit("<div class='entry-content'>"))
    html = _sermons(spark, sf_dir, head, ("<p>", "</p>"), "</div></article>")
    return _sermon_result(page_local.sermon_pages(html, "article"))


def page_moves(spark, sf_dir):
    """Each customer's orders as a dated list: a heading at the first, then items that carry it."""
    key = F.col("o_orderkey")
    item = F.concat(F.when(key % 5 == 0, "<ol><li><strong>No,</strong> to Nowhere</ol>").otherwise(""), F.lit("<ul><li>\n<strong>\tP"), key.cast("string"), F.lit(",\n</strong>\n to Place "), F.col("o_orderstatus"), F.when(key % 2 == 0, F.concat(F.lit(", from Town "), (key % 9).cast("string"))).otherwise(""), F.lit("\n</ul>"))
    piece = F.concat(F.when(key % 3 == 0, F.concat(F.lit("<h6>\n\t"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("\u2003\n</h6>"))).otherwise(""), item)
    got = page_local.appointments(_pages(_joined(table(spark, sf_dir, "orders"), "o_custkey", "o_orderkey", piece)))
    return got.select("page_id", F.col("date").alias("heading"), F.col("name").alias("person"), F.col("to").alias("to_place"), F.col("from").alias("from_place"))


def _pagers(spark, sf_dir) -> DataFrame:
    key = F.col("c_custkey")
    k = key.cast("string")
    html = F.concat(
        F.when(key % 3 == 0, F.concat(F.lit("<a class='paginate_button next' href='/n"), k, F.lit("'>x</a>"))).when(key % 3 == 1, F.concat(F.lit("<a href='/p'>1</a><a href='/m"), k, F.lit("'>Next page</a>"))).otherwise(""),
        F.when(key % 4 == 0, F.concat(F.lit("<p>Page 1 of "), (key % 40 + 1).cast("string"), F.lit("</p>"))).when(key % 4 == 1, F.concat(F.lit("<a class='page-numbers'>2</a><a class='page-numbers'>"), (key % 30 + 3).cast("string"), F.lit("</a>"))).otherwise(""),
        F.when(key % 5 == 0, F.concat(F.lit("<script>$('t').DataTable({ajax: '/list?c="), k, F.lit("'})</script>"))).otherwise(F.lit("<script>x({url: '/no'})</script>")),
    )
    return table(spark, sf_dir, "customer").select(key.alias("page_id"), F.lit("u").alias("url"), html.alias("html"))


def page_pagers(spark, sf_dir):
    html = _pagers(spark, sf_dir)
    nodes = _nodes(html)
    counts = pages.page_counts(html, nodes).withColumnRenamed("value", "n_pages")
    return counts.join(pages.next_links(nodes).withColumnRenamed("value", "next_link"), "page_id", "left").join(pages.ajax_urls(nodes).withColumnRenamed("value", "ajax"), "page_id", "left")


def page_documents(spark, sf_dir):
    key = F.col("o_orderkey")
    link = F.concat(F.lit("<table><tr><td><a href='/f"), (key % 40).cast("string"), F.when(key % 4 > 0, ".pdf").otherwise(".doc"), F.lit("'>F"), key.cast("string"), F.lit("</a></table>"))
    piece = F.concat(F.when(key % 5 == 0, F.concat(F.lit("<h3>S"), key.cast("string"), F.lit("</h3>"))).otherwise(""), link)
    html = _pages(_joined(table(spark, sf_dir, "orders"), "o_custkey", "o_orderkey", piece))
    return page_local.links_by_section(html, base="http://b")


def page_bulletins(spark, sf_dir):
    key = F.col("o_orderkey")
    piece = F.concat(F.lit("<a href='https://f.ecatholic.com/"), key.cast("string"), F.when(key % 2 == 0, "/bulletins/").otherwise("/other/"), (key % 100).cast("string"), F.lit(".pdf?x=1'>b</a>"))
    html = _pages(_joined(table(spark, sf_dir, "orders"), "o_custkey", "o_orderkey", piece), F.when(F.col("page_id") % 9 == 0, F.lit("<title>Just a moment...</title>")).otherwise("<title>t</title>"))
    return page_local.bulletin_pages(html).select("page_id", F.col("pos").cast("int").alias("pos"), "name", "blocked")


def select_documents(spark, sf_dir):
    """Documents as yearly reports: sections by source, labels with a year, some of them done."""
    label = F.concat((2000 + F.col("doc_id") % 26).cast("string"), F.when(F.col("doc_id") % 2 == 0, "–").otherwise("/"), F.lpad((F.col("doc_id") % 100).cast("string"), 2, "0"))
    docs = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 10 == 0, "Other").otherwise("Annual").alias("section"), label.alias("label"))
    done = docs.filter("doc_id % 7 = 0").select(F.concat_ws("_", F.lower("section"), F.replace(F.replace("label", F.lit("–"), F.lit("-")), F.lit("/"), F.lit("-"))).alias("section_slug"))
    return grid.select_documents(docs, done, "Annual", 2010).select("doc_id", "section_slug", "start_year")


QUERIES = {f.__name__: f for f in (
    survey_age_shares, survey_age_stats, survey_young_shares, survey_years_left, survey_boomers, page_histories, page_tables, page_sections, page_facts, page_options,
    page_labelled_rows, page_cards, page_sermons_header, page_sermons_article, page_moves, page_pagers, page_documents, page_bulletins, select_documents,
)}

# ---- SQL

_CODES = ", ".join(f"CASE WHEN o_orderkey % 12 = {i} THEN (o_orderkey // 12) % 10 + 1 END AS {c}" for i, c in enumerate(COLUMNS[:-1]))
_CLAUSES = [(c, code, label) for c, codes in TRADITION_CODES.items() for code, label in codes.items()]
_CASE = "CASE " + " ".join(f"WHEN {c} = {code} THEN {i}" for i, (c, code, _) in enumerate(_CLAUSES, 1)) + " END"
_LABELS = "[" + ", ".join(f"'{label}'" for _, _, label in _CLAUSES) + "]"
_PEOPLE = f"""
r AS (SELECT 2006 + o_orderkey % 19 AS year, CASE WHEN o_orderkey % 50 <> 0 THEN 1915 + (o_custkey * 7 + o_orderkey) % 95 END AS birthyr, 0.5 + (o_orderkey % 7) / 4 AS weight, {_CODES},
  CASE WHEN o_orderkey % 12 = 11 OR o_orderkey % 5 = 0 THEN 1 END AS {COLUMNS[-1]} FROM orders),
o AS (SELECT year, birthyr, weight, {_CASE} AS trad_ord FROM r),
p AS (SELECT *, {_LABELS}[trad_ord] AS trad FROM o),
top AS (SELECT trad FROM p WHERE year >= 2022 AND trad IS NOT NULL AND trad NOT LIKE 'Other%' GROUP BY trad ORDER BY count(*) DESC, min(trad_ord), trad LIMIT 20),
k AS (SELECT * FROM p WHERE trad IN (SELECT trad FROM top))"""

_NUMBER = "CAST(row_number() OVER (PARTITION BY page_id ORDER BY o) - 1 AS INT)"

ORACLE_SQL = {
    "survey_age_shares": f"""
WITH {_PEOPLE}, b AS (SELECT trad, CASE WHEN 2024 - birthyr < 18 THEN NULL WHEN 2024 - birthyr < 30 THEN '18–29' WHEN 2024 - birthyr < 45 THEN '30–44' WHEN 2024 - birthyr < 60 THEN '45–59' WHEN 2024 - birthyr < 75 THEN '60–74' WHEN birthyr IS NOT NULL THEN '75+' END AS age_bucket FROM k WHERE year >= 2022),
n AS (SELECT trad, age_bucket, count(*) AS n FROM b GROUP BY 1, 2), s AS (SELECT *, n / sum(n) OVER (PARTITION BY trad) AS pct FROM n),
x AS (SELECT *, max(pct) FILTER (age_bucket = '75+') OVER (PARTITION BY trad) AS pct75 FROM s)
SELECT trad, age_bucket, n, round(pct, 4) AS pct, round(pct75, 4) AS pct75, CAST(dense_rank() OVER (ORDER BY pct75 NULLS LAST, trad) AS INT) AS ord FROM x""",
    "survey_age_stats": f"""
WITH {_PEOPLE}, a AS (SELECT trad, 2024 - birthyr AS age FROM k WHERE year >= 2022 AND birthyr IS NOT NULL), c AS (SELECT trad, age, count(*) AS c FROM a GROUP BY 1, 2),
m AS (SELECT trad, age FROM (SELECT *, row_number() OVER (PARTITION BY trad ORDER BY c DESC, age) AS rn FROM c) WHERE rn = 1),
s AS (SELECT trad, avg(age) AS mean_age, count(*) AS n FROM a GROUP BY 1), t AS (SELECT *, CAST(row_number() OVER (ORDER BY mean_age, trad) AS INT) AS ord FROM s)
SELECT trad, 'mean_age' AS stat, round(mean_age, 4) AS age, n, ord FROM t UNION ALL SELECT trad, 'mode_age', CAST(age AS DOUBLE), n, ord FROM t JOIN m USING (trad)""",
    "survey_young_shares": f"""
WITH {_PEOPLE}, a AS (SELECT trad, year - birthyr AS age, weight, CASE WHEN year BETWEEN 2008 AND 2010 THEN '2008–2010' WHEN year BETWEEN 2022 AND 2024 THEN '2022–2024' END AS period FROM k),
s AS (SELECT period, trad, sum(CASE WHEN age <= 40 THEN weight ELSE 0 END) / sum(weight) AS x, count(*) AS n_eff FROM a WHERE period IS NOT NULL AND age BETWEEN 18 AND 100 GROUP BY 1, 2),
l AS (SELECT *, max(x) FILTER (period = '2022–2024') OVER (PARTITION BY trad) AS later FROM s)
SELECT period, trad, round(x, 4) AS pct_18_40, n_eff, CAST(dense_rank() OVER (ORDER BY later DESC NULLS LAST, trad) AS INT) AS ord FROM l""",
    "survey_years_left": f"""
WITH {_PEOPLE}, a AS (SELECT trad, greatest(0, 85 - least(greatest(year - birthyr, 18), 100)) AS x, weight FROM k WHERE year BETWEEN 2022 AND 2024 AND birthyr IS NOT NULL),
s AS (SELECT trad, x, sum(weight) AS t FROM a GROUP BY 1, 2), c AS (SELECT trad, x, sum(t) OVER (PARTITION BY trad ORDER BY x) AS cw, sum(t) OVER (PARTITION BY trad) AS n FROM s),
q AS (SELECT c.*, label, 1 + (n - 1) * pr AS h FROM c, (VALUES ('30%', 0.3::DOUBLE), ('40%', 0.4::DOUBLE), ('50%', 0.5::DOUBLE)) v(label, pr)),
y AS (SELECT trad, label, (1 - max(h - floor(h))) * coalesce(min(x) FILTER (cw >= greatest(floor(h), 1)), max(x)) + max(h - floor(h)) * coalesce(min(x) FILTER (cw >= least(greatest(floor(h), 1) + 1, n)), max(x)) AS v FROM q GROUP BY 1, 2),
z AS (SELECT trad, CAST(row_number() OVER (ORDER BY v, trad) AS INT) AS ord FROM y WHERE label = '50%')
SELECT trad, label AS threshold, round(2024 + v, 4) AS death_year, ord FROM y JOIN z USING (trad)""",
    "survey_boomers": f"""
WITH {_PEOPLE}, s AS (SELECT trad, sum(CASE WHEN birthyr BETWEEN 1946 AND 1964 THEN weight ELSE 0 END) / sum(weight) AS x, count(*) AS n_eff FROM k WHERE year BETWEEN 2022 AND 2024 AND year - birthyr BETWEEN 18 AND 100 GROUP BY 1)
SELECT trad, round(x, 4) AS pct_boomer, n_eff, CAST(row_number() OVER (ORDER BY x, trad) AS INT) AS ord FROM s""",
    "page_histories": f"""
WITH r AS (SELECT o_custkey AS page_id, o_orderkey AS o, CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT page_id, {_NUMBER} AS row_idx, 'Place ' || o AS place, 'https://b/c?church=' || o AS link, strftime(d, '%Y-%m-%d') AS start_date, CASE WHEN o % 2 = 1 THEN strftime(d + 9, '%Y-%m-%d') END AS end_date, 'http://x/' || o AS chart, 6 AS n_fields FROM r""",
    "page_tables": f"""
WITH r AS (SELECT o_custkey AS page_id, o_orderkey AS o, CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT page_id, {_NUMBER} AS row_idx, strftime(d, '%-m/%-d/%Y') || ' - ' || CASE WHEN o % 2 = 0 THEN 'Present' ELSE strftime(d + 9, '%-m/%-d/%Y') END AS dates, 3 AS n_fields FROM r""",
    "page_sections": f"SELECT page_id, {_NUMBER} AS pos, name, 'http://b/s' || o AS url FROM (SELECT CAST(s_nationkey * 1000000000::BIGINT + s_suppkey // 100 AS BIGINT) AS page_id, s_suppkey AS o, s_name AS name FROM supplier)",
    "page_facts": f"""
WITH r AS (SELECT CAST(s_nationkey * 1000000000::BIGINT + s_suppkey // 100 AS BIGINT) AS page_id, s_suppkey AS o, s_name AS name, CASE WHEN s_suppkey % 3 > 0 THEN CAST(CAST(round(s_acctbal * 100) AS BIGINT) AS VARCHAR) ELSE '0' END AS c FROM supplier WHERE s_suppkey % 4 > 0)
SELECT page_id, {_NUMBER} AS row_idx, name, '/s' || o AS url, c AS c0, c AS c7 FROM r""",
    "page_options": "SELECT CAST(s_nationkey * 1000000000::BIGINT + s_suppkey // 100 AS BIGINT) AS page_id, CAST(s_suppkey AS VARCHAR) AS id, s_name AS name FROM supplier WHERE s_suppkey % 5 > 0",
    "page_labelled_rows": "SELECT CAST(s_nationkey * 1000000000::BIGINT + s_suppkey // 100 AS BIGINT) AS page_id, s_name AS name, 'Town ' || s_suppkey AS city, '/n' AS url FROM supplier WHERE s_suppkey % 6 > 0 AND s_suppkey % 7 > 0",
    "page_cards": """
SELECT s_suppkey AS page_id, CASE WHEN s_suppkey % 3 > 0 THEN 'The ' || s_name ELSE s_name END AS name, CASE WHEN s_suppkey % 2 = 0 THEN CAST(2000 + s_suppkey % 25 AS VARCHAR) END AS year, s_suppkey % 4 = 0 AS flag,
  CAST(CAST(round(s_acctbal * 100) AS BIGINT) AS VARCHAR) AS balance, CAST(s_nationkey AS VARCHAR) AS nation, 2 AS n_facts FROM supplier""",
    "page_sermons_header": r"""
SELECT 'http://d/' || doc_id AS url, 'Talk ' || doc_id AS title, '2021-03-05' AS date, 'John ' || doc_id AS scripture, coalesce(source, '') AS speaker,
  md5(array_to_string(list_filter(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: trim(x)), lambda x: x <> ''), chr(10) || chr(10))) AS text_md5 FROM documents""",
    "page_sermons_article": r"""
SELECT 'http://d/' || doc_id AS url, 'Talk ' || doc_id AS title, '2020-01-02' AS date, '' AS scripture, CASE WHEN doc_id % 2 = 0 THEN 'Mary Ann' ELSE '' END AS speaker,
  md5(array_to_string(list_filter(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: trim(x)), lambda x: x <> ''), chr(10) || chr(10))) AS text_md5 FROM documents""",
    "page_moves": """
SELECT o_custkey AS page_id, last_value(CASE WHEN o_orderkey % 3 = 0 THEN strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') END IGNORE NULLS) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) AS heading,
  'P' || o_orderkey AS person, 'Place ' || o_orderstatus AS to_place, CASE WHEN o_orderkey % 2 = 0 THEN 'Town ' || (o_orderkey % 9) END AS from_place FROM orders""",
    "page_pagers": """
SELECT c_custkey AS page_id, CAST(CASE c_custkey % 4 WHEN 0 THEN c_custkey % 40 + 1 WHEN 1 THEN c_custkey % 30 + 3 ELSE 1 END AS INT) AS n_pages,
  CASE c_custkey % 3 WHEN 0 THEN '/n' || c_custkey WHEN 1 THEN '/m' || c_custkey END AS next_link, CASE WHEN c_custkey % 5 = 0 THEN '/list?c=' || c_custkey END AS ajax FROM customer""",
    "page_documents": """
WITH r AS (SELECT o_custkey AS page_id, o_orderkey AS o, last_value(CASE WHEN o_orderkey % 5 = 0 THEN 'S' || o_orderkey END IGNORE NULLS) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) AS section FROM orders),
f AS (SELECT *, 'http://b/f' || (o % 40) || '.pdf' AS url, row_number() OVER (PARTITION BY page_id, o % 40 ORDER BY o) AS rn FROM r WHERE o % 4 > 0 AND section IS NOT NULL)
SELECT page_id, section, 'F' || o AS label, url FROM f WHERE rn = 1""",
    "page_bulletins": f"SELECT page_id, {_NUMBER} AS pos, (o % 100) || '.pdf' AS name, page_id % 9 = 0 AS blocked FROM (SELECT o_custkey AS page_id, o_orderkey AS o FROM orders WHERE o_orderkey % 2 = 0)",
    "select_documents": """
WITH d AS (SELECT doc_id, CAST(2000 + doc_id % 26 AS INT) AS start_year, (2000 + doc_id % 26) || '-' || lpad(CAST(doc_id % 100 AS VARCHAR), 2, '0') AS slug FROM documents WHERE doc_id % 10 > 0)
SELECT doc_id, 'annual_' || slug AS section_slug, start_year FROM d WHERE start_year >= 2010 AND slug NOT IN (SELECT slug FROM d WHERE doc_id % 7 = 0)""",
}

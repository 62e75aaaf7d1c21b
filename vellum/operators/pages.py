"""Records from web pages, as joins and windows over a table of page elements.

``html_nodes`` parses each page once, in Arrow batches, into one row an element in document order. Every other operator is
a DataFrame expression over that table. Text comes in three forms: every string trimmed and joined without
a blank (``text``) or with one (``text_sp``), and raw (``text_raw``). ``last_id`` is the number of an element's last
descendant, so "inside" is a range of numbers within one page. Only elements of the tags asked for are there.

Tables, sermons, dated lists and links are made without moving elements, see ``page_local``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.functions import scalars as S
from vellum.operators.html_tree import tree_of

NODES = "page_id bigint, node_id int, parent_id int, last_id int, depth int, tag string, id string, classes array<string>, attrs map<string,string>, text string, text_sp string, text_raw string, own array<string>"

def _parser(texts: frozenset[str] | None, tags: frozenset[str] | None):
    names = ["page_id", "node_id", "parent_id", "last_id", "depth", "tag", "id", "classes", "attrs", "text", "text_sp", "text_raw", "own"]
    types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.list_(pa.string()), pa.map_(pa.string(), pa.string()), *[pa.string()] * 3, pa.list_(pa.string())]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in names]
            size = 0
            for page, html in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                tree = tree_of(html.as_py() or "")
                strings = [s for _, s in tree.strings]
                bare = [s.strip() for s in strings]
                numbers = range(len(tree.rows)) if tags is None else [i for i, row in enumerate(tree.rows) if row["tag"] in tags]
                rows, forms = [tree.rows[i] for i in numbers], []
                for row in rows:
                    if texts is not None and row["tag"] not in texts:
                        forms.append((None, None, None))
                        continue
                    own, raw = [s for s in bare[row["start"] : row["end"]] if s], "".join(strings[row["start"] : row["end"]])
                    forms.append(("".join(own), " ".join(own), raw))
                    size += 3 * len(raw)
                own_attrs = [row["attrs"] for row in rows]
                columns = [
                    [page] * len(rows), numbers, *([row[c] for row in rows] for c in ("parent", "last", "depth", "tag")),
                    [a.get("id") for a in own_attrs], [a["class"].split() if "class" in a else [] for a in own_attrs], [list(a.items()) for a in own_attrs],
                    *([f[i] for f in forms] for i in range(3)), [row["own"] for row in rows],
                ]
                for held, more in zip(out, columns, strict=True):
                    held.extend(more)
                size += 200 * len(rows)
                if size > 16_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, types, strict=True)], names)
                    out, size = [[] for _ in names], 0
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, types, strict=True)], names)

    return parse


def html_nodes(pages: DataFrame, texts: tuple[str, ...] | None = None, tags: tuple[str, ...] | None = None) -> DataFrame:
    """Element table of pages(page_id, url, html).

    A text is repeated in every element around it, so name in ``texts`` the tags whose text is needed; the others get null. With ``tags`` only
    elements of these are there, numbered as in the whole page.
    """
    named = lambda x: None if x is None else frozenset(x)
    return pages.select("page_id", "html").mapInArrow(_parser(named(texts), named(tags)), NODES)


def has_class(name: str, classes: str = "classes") -> Column:
    return F.array_contains(classes, name)


def inside(outer: DataFrame, nodes: DataFrame, keep: dict[str, str] | None = None) -> DataFrame:
    """Elements of ``nodes`` inside elements of ``outer``, with the outer's columns ``keep`` (name there: name here)."""
    keep = {"node_id": "outer_id"} | (keep or {})
    o = outer.select(F.col("page_id").alias("_p"), F.col("node_id").alias("_a"), F.col("last_id").alias("_z"), *(F.col(a).alias(b) for a, b in keep.items()))
    return nodes.join(o, (F.col("page_id") == F.col("_p")) & (F.col("node_id") > F.col("_a")) & (F.col("node_id") <= F.col("_z"))).drop("_p", "_a", "_z")


def first_of(nodes: DataFrame, by: list[str] = ["page_id"], order: str = "node_id") -> DataFrame:  # noqa: B006
    """The first element of each page (or of each ``by``)."""
    return nodes.withColumn("_rn", F.row_number().over(Window.partitionBy(*by).orderBy(order))).filter("_rn = 1").drop("_rn")


def _cells(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """Cells of rows, numbered from 0: (page_id, row_id, col_idx, ...)."""
    cells = inside(rows, nodes.filter(F.col("tag").isin("td", "th"))).withColumnRenamed("outer_id", "row_id")
    return cells.withColumn("col_idx", F.row_number().over(Window.partitionBy("page_id", "row_id").orderBy("node_id")) - 1)


def section_links(nodes: DataFrame, name: str, base: str = "") -> DataFrame:
    """(page_id, pos, name, url): first links of the rows, but for the header row, of the table in the named section.

    The section is the nearest div or section around the first h2 that holds the name, in any case, else what follows it.
    """
    title = first_of(nodes.filter((F.col("tag") == "h2") & F.contains(F.lower("text"), F.lit(name.lower()))))
    h = title.select(F.col("page_id").alias("_p"), F.col("node_id").alias("_h"), F.col("last_id").alias("_z"), F.col("parent_id").alias("_up"))
    around = nodes.filter(F.col("tag").isin("div", "section")).join(h, (F.col("page_id") == F.col("_p")) & (F.col("node_id") < F.col("_h")) & (F.col("last_id") >= F.col("_h")))
    nearest = around.withColumn("_rn", F.row_number().over(Window.partitionBy("page_id").orderBy(F.desc("node_id")))).filter("_rn = 1")
    after = nodes.join(h, (F.col("page_id") == F.col("_p")) & F.col("parent_id").eqNullSafe(F.col("_up")) & (F.col("node_id") > F.col("_z")))
    following = first_of(after).join(nearest.select("page_id"), "page_id", "left_anti")
    box = nearest.select("page_id", "node_id", "last_id").union(following.select("page_id", "node_id", "last_id"))
    table = first_of(inside(box, nodes.filter("tag = 'table'")).drop("outer_id"))
    rows = inside(table, nodes.filter("tag = 'tr'")).drop("outer_id")
    rows = rows.withColumn("_n", F.row_number().over(Window.partitionBy("page_id").orderBy("node_id"))).filter("_n > 1")
    first_cell = _cells(rows, nodes).filter("col_idx = 0")
    link = first_of(inside(first_cell, nodes.filter("tag = 'a'"), {}), ["page_id", "outer_id"])
    pos = F.row_number().over(Window.partitionBy("page_id").orderBy("node_id")) - 1
    return link.select("page_id", pos.alias("pos"), F.col("text").alias("name"), S.absolutise(F.try_element_at("attrs", F.lit("href")), base).alias("url"))


def fact_table(nodes: DataFrame, cols: list[str], base: str = "", least: int = 9) -> DataFrame:
    """(page_id, row_idx, name, url, cols...): rows of the first table with ``least`` cells or more and a link in the first; counts without commas."""
    table = first_of(nodes.filter("tag = 'table'"))
    rows = inside(table, nodes.filter("tag = 'tr'")).drop("outer_id")
    rows = rows.withColumn("_n", F.row_number().over(Window.partitionBy("page_id").orderBy("node_id"))).filter("_n > 1")
    cells = _cells(rows, nodes)
    link = first_of(inside(cells.filter("col_idx = 0"), nodes.filter("tag = 'a'"), {"row_id": "row"}), ["page_id", "row"]).select("page_id", F.col("row").alias("row_id"), F.col("text").alias("name"), S.absolutise(F.try_element_at("attrs", F.lit("href")), base).alias("url"))
    wide = cells.groupBy("page_id", "row_id").agg(F.count("*").alias("_c"), *(S.count_text(F.max(F.when(F.col("col_idx") == i + 1, F.col("text")))).alias(c) for i, c in enumerate(cols)))
    idx = F.row_number().over(Window.partitionBy("page_id").orderBy("row_id")) - 1
    return wide.filter(F.col("_c") >= least).join(link, ["page_id", "row_id"]).select("page_id", idx.alias("row_idx"), "name", "url", *cols)


def select_options(nodes: DataFrame, ids: list[str], drop_parenthesis: bool = True) -> DataFrame:
    """(page_id, id, name): options with value and text of the first of the named selects that a page has; a later equal name wins."""
    rank = F.coalesce(*(F.when(F.col("id") == v, i) for i, v in enumerate(ids)))
    box = nodes.filter((F.col("tag") == "select") & F.col("id").isin(ids)).withColumn("_rank", rank)
    box = first_of(box.withColumn("_o", F.struct("_rank", "node_id")), ["page_id"], "_o")
    options = inside(box, nodes.filter("tag = 'option'"))
    value, name = F.try_element_at("attrs", F.lit("value")), S.drop_abbrev("text") if drop_parenthesis else F.col("text")
    kept = options.select("page_id", "node_id", value.alias("id"), name.alias("name")).filter("coalesce(id, '') <> '' and coalesce(name, '') <> ''")
    return kept.groupBy("page_id", "name").agg(F.max_by("id", "node_id").alias("id")).select("page_id", "id", "name")


def labelled_cells(nodes: DataFrame, labels: dict[str, str], name_label: str, city_label: str | None = None) -> DataFrame:
    """(page_id, row_id, url, fields...): row cells by their data-label.

    A row without a name cell is dropped. The city is the first string of its cell that is not blank; a city cell without one
    drops its row. ``labels``: field name by label.
    """
    rows = nodes.filter("tag = 'tr'")
    cells = inside(rows, nodes.filter("tag = 'td'"), {}).withColumnRenamed("outer_id", "row_id").withColumn("label", S.strip(F.try_element_at("attrs", F.lit("data-label"))))
    own = F.try_element_at(F.filter(F.transform("own", lambda s: S.strip(s)), lambda s: s != ""), F.lit(1))
    link = first_of(inside(cells.filter(F.col("label") == name_label), nodes.filter("tag = 'a'"), {"row_id": "row"}), ["page_id", "row"]).select("page_id", F.col("row").alias("row_id"), F.try_element_at("attrs", F.lit("href")).alias("url"))
    fields = [F.min_by(F.when(F.col("label") == label, own if label == city_label else F.col("text")), F.when(F.col("label") == label, F.col("node_id"))).alias(field) for label, field in labels.items()]
    lost = F.bool_or((F.col("label") == city_label) & own.isNull()) if city_label else F.lit(False)
    wide = cells.groupBy("page_id", "row_id").agg(*fields, F.bool_or(F.col("label") == name_label).alias("_name"), F.coalesce(lost, F.lit(False)).alias("_lost"))
    return wide.filter("_name and not _lost").join(link, ["page_id", "row_id"], "left").select("page_id", "row_id", "url", *labels.values())


def page_names(nodes: DataFrame, suffix: str = " - UMData") -> DataFrame:
    """(page_id, name, heading): first line of h1, else the title without its suffix; and h1 with blanks collapsed."""
    first = lambda tag: F.min_by(F.when(F.col("tag") == tag, F.col("text_raw")), F.when(F.col("tag") == tag, F.col("node_id")))
    tops = nodes.filter(F.col("tag").isin("h1", "title")).groupBy("page_id").agg(first("h1").alias("h"), first("title").alias("t"))
    line = F.nullif(S.strip(F.split(S.strip("h"), "\n")[0]), F.lit(""))
    title = S.strip(F.replace("t", F.lit(suffix), F.lit("")))
    return tops.select("page_id", F.coalesce(line, title).alias("name"), S.strip(F.regexp_replace("h", r"(?U)\s+", " ")).alias("heading"))


def church_pages(nodes: DataFrame, card: str = "Quick Facts", flag_id: str = "hci-download") -> DataFrame:
    """(page_id, name, year, flag, facts): name, year of the card, whether a flagged table exists, and the card's facts."""
    ids = nodes.select("page_id").distinct()
    heads = nodes.filter(F.col("tag").isin("h1", "h2", "h3", "h4", "h5", "h6", "div") & F.contains("text", F.lit(card)))
    year = heads.groupBy("page_id").agg(F.min_by(S.extracted("text", r"\((\d{4})\)"), F.when(F.col("text").rlike(r"\((\d{4})\)"), F.col("last_id") - F.col("node_id"))).alias("year"))
    flag = nodes.groupBy("page_id").agg(F.bool_or((F.col("tag") == "table") & (F.coalesce("id", F.lit("")) == flag_id)).alias("flag"))
    boxes = first_of(nodes.filter(has_class("card") & F.contains("text", F.lit(card))).withColumn("_o", F.struct(F.col("last_id") - F.col("node_id"), "node_id")), ["page_id"], "_o")
    items = inside(boxes, nodes.filter("tag = 'li'")).drop("outer_id")
    values = first_of(inside(items, nodes.filter(F.col("tag").isin("span", "strong", "b")), {"text": "item"}), ["page_id", "outer_id"])
    value = S.fact_value("text")
    label = S.strip(F.regexp_replace(F.replace("item", F.col("text"), F.lit("")), ":$", ""))
    facts = values.select("page_id", "node_id", label.alias("k"), value.alias("v")).filter("k <> '' and v <> ''")
    facts = facts.groupBy("page_id", "k").agg(F.max_by("v", "node_id").alias("v")).groupBy("page_id").agg(F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("facts"))
    out = ids.join(page_names(nodes), "page_id", "left").join(year, "page_id", "left").join(flag, "page_id", "left").join(facts, "page_id", "left")
    return out.select("page_id", "name", "year", "flag", F.coalesce("facts", F.expr("cast(map() as map<string,string>)")).alias("facts"))


# How a script names the link of its table, and how a page tells its number of pages.
AJAX = r"""["']?(?:url|ajax)["']?\s*:\s*["']([^"']+)["']"""
PAGE_COUNT = r"(?i)Page\s+\d+\s+of\s+(\d+)"


def ajax_urls(nodes: DataFrame, mark: str = "DataTable", pattern: str = AJAX) -> DataFrame:
    """(page_id, value): the first link in a script that mentions a table widget."""
    found = nodes.filter((F.col("tag") == "script") & F.contains("text_raw", F.lit(mark))).select("page_id", "node_id", S.extracted("text_raw", pattern).alias("value"))
    return first_of(found.filter("value is not null")).select("page_id", "value")


def next_links(nodes: DataFrame) -> DataFrame:
    """(page_id, value): an enabled button for the next page, else the first link that reads like one."""
    a = nodes.filter("tag = 'a'")
    button = has_class("paginate_button") & has_class("next") & ~has_class("disabled")
    rule = F.when(button, 1).when(F.col("text").rlike("(?i)next|»|>"), 2)
    return first_of(a.withColumn("_o", F.struct(rule.alias("r"), "node_id")).filter(rule.isNotNull()), ["page_id"], "_o").select("page_id", F.try_element_at("attrs", F.lit("href")).alias("value"))


def page_counts(pages: DataFrame, nodes: DataFrame) -> DataFrame:
    """(page_id, value): 'Page x of N' in the page or its text, else the largest page number linked, else 1."""
    of = lambda c: S.extracted(c, PAGE_COUNT).try_cast("int")
    whole = first_of(nodes.filter("parent_id is null")).select("page_id", of("text_sp").alias("t"))
    numbers = nodes.filter((F.col("tag") == "a") & has_class("page-numbers")).groupBy("page_id").agg(F.max(F.expr("try_cast(text as int)")).alias("m"))
    return pages.select("page_id", of("html").alias("h")).join(whole, "page_id", "left").join(numbers, "page_id", "left").select("page_id", F.coalesce("h", "t", "m", F.lit(1)).alias("value"))


def blocked_pages(nodes: DataFrame, mark: str = "Just a moment") -> DataFrame:
    """(page_id, blocked): whether the title says that a visitor has to wait."""
    return nodes.groupBy("page_id").agg(F.coalesce(F.bool_or((F.col("tag") == "title") & F.contains("text_raw", F.lit(mark))), F.lit(False)).alias("blocked"))

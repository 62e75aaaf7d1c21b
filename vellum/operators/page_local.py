"""Records from web pages without moving their elements: one row a page, with an array of the elements that are asked for.

``html_elements`` parses a page in an Arrow batch and gives its elements of the named tags and classes in document order, each with its
place in the array (``at``) and that of its last descendant there (``end``). What lies inside an element is then a slice, what comes
under a heading is the slice up to the next one, and the first of a kind is a filter. Records are made by expressions over the array and
unfolded at the end, so nothing is shuffled by page.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.functions import scalars as S
from vellum.operators.html_tree import tree_of

Rule = Callable[[Column], Column]

TYPES = {
    "at": pa.int32(), "end": pa.int32(), "tag": pa.string(), "parent": pa.string(), "id": pa.string(), "classes": pa.list_(pa.string()), "attrs": pa.map_(pa.string(), pa.string()),
    "text": pa.string(), "text_sp": pa.string(), "text_raw": pa.string(),
}
#: Bytes of texts and elements after which a batch is handed on.
BATCH = 16_000_000


def _parser(tags: frozenset[str] | None, classes: frozenset[str], texts: frozenset[str], fields: tuple[str, ...]):
    forms = [f for f in ("text", "text_sp", "text_raw") if f in fields]
    parents, idents, classed, attributed = ("parent" in fields, "id" in fields, "classes" in fields, "attrs" in fields)
    kinds = [TYPES[f] for f in fields]

    def elements_of(html: str, held: dict[str, list]) -> tuple[int, int]:
        """Adds a page's elements to the columns; how many they are, and their bytes."""
        tree, size, upto, ends, n = tree_of(html), 0, [], [], 0
        strings = [s for _, s in tree.strings]
        for row in tree.rows:
            attrs, tag = row["attrs"], row["tag"]
            own = attrs["class"].split() if "class" in attrs else []
            if tags is None or tag in tags or (own and not classes.isdisjoint(own)):
                held["at"].append(n)
                held["tag"].append(tag)
                ends.append(row["last"])
                n += 1
                if parents:
                    held["parent"].append(None if row["parent"] is None else tree.rows[row["parent"]]["tag"])
                if idents:
                    held["id"].append(attrs.get("id"))
                if classed:
                    held["classes"].append(own)
                if attributed:
                    held["attrs"].append(list(attrs.items()))
                if forms:
                    if tag in texts or (own and not texts.isdisjoint(own)):
                        inner = strings[row["start"] : row["end"]]
                        bare = [s for s in (x.strip() for x in inner) if s]
                        for form in forms:
                            made = "".join(bare) if form == "text" else " ".join(bare) if form == "text_sp" else "".join(inner)
                            held[form].append(made)
                            size += len(made)
                    else:
                        for form in forms:
                            held[form].append(None)
            upto.append(n - 1)
        held["end"].extend([upto[last] for last in ends])
        return n, size + 200 * n

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done, held, offsets, size = 0, {f: [] for f in fields}, [0], 0
            for i, html in enumerate(batch.column(2)):
                n, more = elements_of(html.as_py() or "", held)
                offsets.append(offsets[-1] + n)
                size += more
                if size > BATCH or i == batch.num_rows - 1:
                    rows = batch.slice(done, len(offsets) - 1)
                    parts = pa.StructArray.from_arrays([pa.array(held[f], t) for f, t in zip(fields, kinds, strict=True)], fields=[pa.field(f, t) for f, t in zip(fields, kinds, strict=True)])
                    yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), parts)], ["page_id", "url", "els"])
                    done, held, offsets, size = i + 1, {f: [] for f in fields}, [0], 0

    return parse


_SQL = {"at": "int", "end": "int", "classes": "array<string>", "attrs": "map<string,string>"}


def html_elements(pages: DataFrame, tags: str = "", texts: str = "", fields: str = "", classes: str = "") -> DataFrame:
    """(page_id, url, els) of pages(page_id, url, html): the elements of the named tags, or classes, with the named fields.

    Names are separated by blanks; without tags and classes all elements are there. ``at``, ``end`` and ``tag`` always are; of the fields parent
    (its tag), id, classes, attrs, text, text_sp and text_raw only those asked for, and texts only for the tags or classes in ``texts``.
    A page without such elements, or without markup, has an empty array.
    """
    chosen = ("at", "end", "tag", *fields.split())
    element = ", ".join(f"`{f}`: {_SQL.get(f, 'string')}" for f in chosen)
    named = frozenset(tags.split()) if tags or classes else None
    parse = _parser(named, frozenset(classes.split()), frozenset(texts.split()), chosen)
    return pages.select("page_id", "url", "html").mapInArrow(parse, f"page_id bigint, url string, els array<struct<{element}>>")


# ---- parts of the array


def is_tag(*tags: str) -> Rule:
    return lambda e: e["tag"].isin(*tags)


def has_class(name: str) -> Rule:
    return lambda e: F.array_contains(e["classes"], name)


def href(e: Column) -> Column:
    return F.try_element_at(e["attrs"], F.lit("href"))


def first(els: Column, rule: Rule) -> Column:
    """The first element for which the rule holds, else null."""
    return F.try_element_at(F.filter(els, rule), F.lit(1))


def within(els: Column, e: Column) -> Column:
    """The elements inside another one; null for no element."""
    return F.slice(els, e["at"] + 2, e["end"] - e["at"])


def under(els: Column, rule: Rule, use: Callable[[Column, Column], Column]) -> Column:
    """``use(heading, elements)`` for each heading, with the elements up to the next one."""

    def parts(heads: Column) -> Column:
        def part(head: Column, i: Column) -> Column:
            stop = F.coalesce(F.get(heads, i + 1)["at"], F.size(els))
            return use(head, F.slice(els, head["at"] + 2, stop - head["at"] - 1))

        return F.transform(heads, part)

    return S.let(F.filter(els, rule), parts)


def inside_any(outer: Column) -> Rule:
    """Whether an element lies inside one of an array."""
    return lambda e: F.exists(outer, lambda o: (o["at"] < e["at"]) & (o["end"] >= e["at"]))


def first_by(items: Column, field: str) -> Column:
    """Items that are the first with their value of a field."""
    return S.let(F.transform(items, lambda x: x[field]), lambda keys: F.filter(items, lambda x, i: F.array_position(keys, x[field]) == i + 1))


def _unfolded(rows: DataFrame, items: Column, names: list[str], pos: str | None = None) -> DataFrame:
    """A row for each item of an array, with its number and fields."""
    flat = rows.select("page_id", F.posexplode(items).alias("_pos", "_x"))
    return flat.select("page_id", *([F.col("_pos").alias(pos)] if pos else []), *(F.col(f"_x.{n}").alias(n) for n in names))


# ---- tables


def _table_parser(links: bool):
    """(page_id, url, html) to (page_id, names, rows): the headers of a page's first table, and its rows' cells with their text and first link."""
    cell, text = pa.struct([("text", pa.string()), ("href", pa.string())]), pa.string()
    row = pa.list_(cell)

    def table_of(html: str) -> tuple[list[str], list[list[tuple[str, str | None]]]]:
        tree = tree_of(html)
        els, strings = tree.rows, [s.strip() for _, s in tree.strings]
        of = lambda tag, box: next((i for i in range(box + 1, els[box]["last"] + 1) if els[i]["tag"] == tag), None) if box is not None else None
        text_of = lambda e: "".join(strings[e["start"] : e["end"]])
        table = next((i for i, e in enumerate(els) if e["tag"] == "table"), None)
        top, body = of("tr", of("thead", table)), of("tbody", table)
        names = [text_of(e) for e in els[top + 1 : els[top]["last"] + 1] if e["tag"] in ("td", "th")] if top is not None else []
        if table is None or (body is None and not links):
            return names, []
        box = table if body is None else body
        lines = [i for i in range(box + 1, els[box]["last"] + 1) if els[i]["tag"] == "tr"][0 if body is not None else 1 :]
        cells = lambda tr: [i for i in range(tr + 1, els[tr]["last"] + 1) if els[i]["tag"] in ("td", "th")]
        href = lambda link: els[link]["attrs"].get("href") if link is not None else None
        return names, [[(text_of(els[c]), href(of("a", c)) if links else None) for c in cells(tr)] for tr in lines]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done, heads, rows, cells, texts, hrefs, size = 0, [], [0], [0], [], [], 0
            for i, html in enumerate(batch.column(2)):
                names, lines = table_of(html.as_py() or "")
                heads.append(names)
                for line in lines:
                    for own, href in line:
                        texts.append(own)
                        hrefs.append(href)
                        size += 20 + len(own) + len(href or "")
                    cells.append(len(texts))
                rows.append(len(cells) - 1)
                if size > BATCH or i == batch.num_rows - 1:
                    flat = pa.StructArray.from_arrays([pa.array(texts, text), pa.array(hrefs, text)], fields=list(cell))
                    nested = pa.ListArray.from_arrays(pa.array(rows, pa.int32()), pa.ListArray.from_arrays(pa.array(cells, pa.int32()), flat, row))
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(done, len(heads)), pa.array(heads, pa.list_(text)), nested], ["page_id", "names", "rows"])
                    done, heads, rows, cells, texts, hrefs, size = i + 1, [], [0], [0], [], [], 0

    return parse


def table_rows(rows: Column, names: Column, links: bool = False, base: str = "", skip_text: str = "View Charts", dates: str = "Dates") -> Column:
    """Rows of cells as maps from header to text; the rules are those of ``html_tables``."""
    entry = lambda k, v: F.struct(k.alias("key"), v.alias("value"))

    def entries(header: Column, cell: Column) -> Column:
        """What a cell gives."""
        if not links:
            return F.array(entry(header, cell["text"]))
        link, dated = S.absolutise(cell["href"], base), (header == dates) & (cell["text"] != "")
        linked, shown = S.or_empty(cell["href"]) != "", header != skip_text
        plain = F.array(F.when(linked, entry(F.concat(header, F.lit("_URL")), link)), F.when(shown, entry(header, cell["text"])))
        spans = S.let(S.date_range(cell["text"]), lambda d: F.array(entry(F.lit("StartDate"), d["start"]), entry(F.lit("EndDate"), d["end"])))
        given = F.when(dated, F.concat(plain, spans)).otherwise(plain)
        return F.filter(given, lambda e: e.isNotNull())

    def last_of_key(found: Column) -> Column:
        keys = F.reverse(F.transform(found, lambda e: e["key"]))
        return S.let(keys, lambda ks: F.filter(found, lambda e, i: F.array_position(ks, e["key"]) == F.size(found) - i))

    def row(cells: Column) -> Column:
        each = F.transform(cells, lambda c, j: S.let(F.coalesce(F.get(names, j), F.concat(F.lit("Column_"), j.cast("string"))), lambda h: entries(h, c)))
        return S.let(F.flatten(each), lambda found: F.map_from_entries(last_of_key(found)))

    return F.filter(F.transform(rows, row), lambda m: F.size(m) > 0)


def html_tables(pages: DataFrame, links: bool = False, base: str = "", skip_text: str = "View Charts", dates: str = "Dates") -> DataFrame:
    """(page_id, row_idx, row): rows of each page's first table as maps from header to text.

    Headers come from the first row of ``thead``; a cell past them is Column_i. Without ``tbody`` all rows but the first are
    used when ``links`` is set, else none. With ``links`` a cell's first link is kept as <header>_URL, cells under
    ``skip_text`` keep only the link, and ``dates`` also gives StartDate and EndDate. A later cell of the same header wins.
    Only cells leave the parser: texts and links that no rule asks for are neither copied nor moved.
    """
    cells = pages.select("page_id", "url", "html").mapInArrow(_table_parser(links), "page_id bigint, names array<string>, rows array<array<struct<text: string, href: string>>>")
    return cells.select("page_id", F.posexplode(table_rows(F.col("rows"), F.col("names"), links, base, skip_text, dates)).alias("row_idx", "row"))


# ---- sermons, documents, lists


def sermon_pages(pages: DataFrame, layout: str) -> DataFrame:
    """(title, date, scripture, speaker, full_text, url) of the pages in a layout: 'header' or 'article'."""
    of = lambda els, rule, field="text": first(els, rule)[field]
    empty = F.lit("")
    if layout == "header":
        els = html_elements(pages, "h2 strong a p", "h2 strong a p date", "classes attrs text text_sp text_raw", "post-single-sermon-header post-single-sermon date")
        div = lambda name: lambda e: is_tag("div")(e) & has_class(name)(e)
        top, box = first(F.col("els"), div("post-single-sermon-header")), first(F.col("els"), div("post-single-sermon"))
        rel = lambda e: F.array_contains(F.split(S.or_empty(F.try_element_at(e["attrs"], F.lit("rel"))), r"\s+"), "tag")
        verse = lambda e: is_tag("strong")(e) & (e["text"] != "") & ~F.contains(e["text"], F.lit("Speaker:"))
        fields = lambda e: [
            of(e, is_tag("h2")).alias("title"), of(e, div("date"), "text_raw").alias("_date"), empty.alias("_stamp"), of(e, verse).alias("scripture"),
            of(e, lambda a: is_tag("a")(a) & rel(a)).alias("speaker"),
        ]
        body, formats = is_tag("p"), S.PAGE_DATES_A
    else:
        els = html_elements(pages, "article time p h2 h3 h4 blockquote", "time p h2 h3 h4 blockquote entry-title", "classes attrs text text_sp text_raw", "entry-content entry-title")
        top = first(F.col("els"), is_tag("article"))
        box = first(within(F.col("els"), top), has_class("entry-content"))
        names = F.transform(F.filter(F.col("_top.classes"), lambda c: c.startswith("tag-")), lambda c: F.initcap(F.replace(F.substring(c, F.lit(5), F.length(c)), F.lit("-"), F.lit(" "))))
        person = F.try_element_at(F.filter(names, lambda n: F.size(F.filter(F.split(n, " "), lambda w: w != "")) >= 2), F.lit(1))
        fields = lambda e: [
            of(e, has_class("entry-title")).alias("title"), of(e, is_tag("time"), "text_raw").alias("_date"), F.try_element_at(of(e, is_tag("time"), "attrs"), F.lit("datetime")).alias("_stamp"),
            empty.alias("scripture"), person.alias("speaker"),
        ]
        body, formats = is_tag("p", "h2", "h3", "h4", "blockquote"), S.PAGE_DATES_B
    found = els.select("url", "els", top.alias("_top"), box.alias("_box")).filter("_top is not null")
    parts = F.filter(within(F.col("els"), F.col("_box")), lambda e: body(e) & (e["text_sp"] != ""))
    text = F.array_join(F.transform(F.coalesce(parts, F.array()), lambda e: e["text_sp"]), "\n\n")
    whole = found.select("url", *fields(within(F.col("els"), F.col("_top"))), text.alias("full_text"))
    date = F.when(S.or_empty("_stamp") != "", F.substring("_stamp", 1, 10)).otherwise(S.text_date("_date", formats)["raw"])
    return whole.withColumn("date", date).select(*(S.or_empty(c).alias(c) for c in ("title", "date", "scripture", "speaker", "full_text")), "url")


def links_by_section(pages: DataFrame, headings: tuple[str, ...] = ("h2", "h3", "h4"), extension: str = ".pdf", base: str = "") -> DataFrame:
    """(page_id, section, label, url): file links of tables under the last heading before them; the first of each link counts."""
    marks = " ".join(headings)
    els = html_elements(pages, f"{marks} table a", f"{marks} a", "attrs text")
    column = F.col("els")

    def found(tables: Column) -> Column:
        kept = lambda e: is_tag("a")(e) & F.lower(href(e)).like(f"%{extension}") & (e["text"] != "") & inside_any(tables)(e)
        link = lambda head, e: F.struct(head["text"].alias("section"), e["text"].alias("label"), S.absolutise(href(e), base).alias("url"))
        return F.flatten(under(column, is_tag(*headings), lambda head, part: F.transform(F.filter(part, kept), lambda e: link(head, e))))

    links = S.let(F.filter(column, is_tag("table")), found)
    return _unfolded(els, S.let(links, lambda x: first_by(x, "url")), ["section", "label", "url"])


def dated_list(pages: DataFrame, head: str = "h6", item: str = "li", parent: str | None = "ul") -> DataFrame:
    """(page_id, pos, date, text, bold): items, directly below ``parent``, with the last heading before them, in document order."""
    els = html_elements(pages, f"{head} {item} strong", f"{head} {item} strong", "parent text_raw")
    column = F.col("els")
    mine = lambda e: is_tag(item)(e) & (e["parent"] == parent if parent else F.lit(True))

    def items(part: Column, date: Column) -> Column:
        bold = lambda e: S.strip(first(part, lambda s: is_tag("strong")(s) & (s["at"] > e["at"]) & (s["at"] <= e["end"]))["text_raw"])
        return F.transform(F.filter(part, mine), lambda e: F.struct(date.alias("date"), S.strip(e["text_raw"]).alias("text"), bold(e).alias("bold")))

    before = F.slice(column, F.lit(1), F.coalesce(first(column, is_tag(head))["at"], F.size(column)))
    dated = under(column, is_tag(head), lambda h, part: items(part, S.strip(h["text_raw"])))
    return _unfolded(els, F.concat(items(before, F.lit(None).cast("string")), F.flatten(dated)), ["date", "text", "bold"], "pos")


def appointments(pages: DataFrame) -> DataFrame:
    """(page_id, date, name, to, from) of a dated list of moves."""
    rows = dated_list(pages).withColumn("_m", S.parse_move("text", "bold"))
    return rows.select("page_id", "date", "_m.name", "_m.to", "_m.from")


# ---- links


def links_of(els: Column, within_class: str | None = None, parent: str | None = None, contains: tuple[str, ...] = (), unique: bool = True) -> Column:
    """Links (href, text) in document order, once each, from inside elements of a class or directly below a tag."""

    def found(outer: Column | None) -> Column:
        def kept(e: Column) -> Column:
            rule = is_tag("a")(e) & (S.or_empty(href(e)) != "")
            for part in contains:
                rule = rule & href(e).contains(part)
            if parent:
                rule = rule & (e["parent"] == parent)
            return rule & inside_any(outer)(e) if outer is not None else rule

        links = F.transform(F.filter(els, kept), lambda e: F.struct(href(e).alias("href"), e["text"].alias("text")))
        return S.let(links, lambda x: first_by(x, "href")) if unique else links

    return S.let(F.filter(els, has_class(within_class)), found) if within_class else found(None)


def page_links(pages: DataFrame, within_class: str | None = None, parent: str | None = None, contains: tuple[str, ...] = (), unique: bool = True) -> DataFrame:
    """(page_id, pos, href, text): the links of ``links_of``, numbered."""
    els = html_elements(pages, "a", "a", "attrs text" + (" parent" if parent else "") + (" classes" if within_class else ""), within_class or "")
    return _unfolded(els, links_of(F.col("els"), within_class, parent, contains, unique), ["href", "text"], "pos")


def bulletin_pages(pages: DataFrame, mark: str = "Just a moment") -> DataFrame:
    """(page_id, pos, href, name, blocked): links to bulletins with their file names, and whether the page's title says that a visitor has to wait."""
    els = html_elements(pages, "a title", "title", "attrs text text_raw")
    blocked = F.exists("els", lambda e: is_tag("title")(e) & F.contains(e["text_raw"], F.lit(mark)))
    flat = els.select("page_id", blocked.alias("blocked"), F.posexplode(links_of(F.col("els"), contains=("ecatholic.com", "/bulletins/"))).alias("pos", "_x"))
    return flat.select("page_id", "pos", "_x.href", S.base_name(S.url_path("_x.href")).alias("name"), "blocked")

"""Page operators on small hand-written pages."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from vellum.operators import html_tree as H
from vellum.operators import page_local as L
from vellum.operators import pages as P


@pytest.fixture(scope="module")
def nodes(spark):
    def make(*htmls):
        df = spark.createDataFrame([(i, f"http://h/{i}", h) for i, h in enumerate(htmls)], "page_id bigint, url string, html string")
        return df, P.html_nodes(df)

    return make


TABLE = "<table><thead><tr><th>Name<th>Town</thead><tbody><tr><td>A<td>B<td>C<tr></tr><tr><td> D </td></tr></tbody></table>"


def test_tree_with_implied_end_tags(nodes):
    _, n = nodes("<ul><li>a<li>b<ul><li>c</ul><li>d</ul><p>x<p>y<br>z</p>")
    got = [(r.tag, r.text_sp) for r in n.orderBy("node_id").collect()]
    assert got == [("ul", "a b c d"), ("li", "a"), ("li", "b c"), ("ul", "c"), ("li", "c"), ("li", "d"), ("p", "x"), ("p", "y z"), ("br", "")]


def test_first_table(nodes):
    n, _ = nodes(TABLE, "<p>none</p>", "")
    got = [(r.page_id, r.row_idx, r.row) for r in L.html_tables(n).orderBy("page_id", "row_idx").collect()]
    assert got == [(0, 0, {"Name": "A", "Town": "B", "Column_2": "C"}), (0, 1, {"Name": "D"})]


def test_history_table(nodes):
    html = "<table><thead><tr><th>Appointment<th>Dates<th>View Charts</thead><tbody><tr><td><a href='/c?church=3'>Grace</a><td>1/2/2020 - Present<td><a href='http://x/y'>chart</a></tbody></table>"
    bare = "<table><tr><th>h</tr><tr><td>v</td></tr></table>"
    n, _ = nodes(html, bare)
    got = {r.page_id: r.row for r in L.html_tables(n, links=True, base="https://b").collect()}
    assert got[0] == {"Appointment_URL": "https://b/c?church=3", "Appointment": "Grace", "Dates": "1/2/2020 - Present", "StartDate": "2020-01-02", "EndDate": None, "View Charts_URL": "http://x/y"}
    assert got[1] == {"Column_0": "v"}


def test_section_links(nodes):
    html = "<div><h2>All Jurisdictions here</h2><table><tr><th>N</tr><tr><td><a href='/j1'>One</a></td></tr><tr><td>no link</td></tr></table></div><div><h2>Other</h2><table><tr><td></td></tr><tr><td><a href='/no'>x</a></table></div>"
    _, n = nodes(html)
    assert [tuple(r)[1:] for r in P.section_links(n, "jurisdictions", "http://b").collect()] == [(0, "One", "http://b/j1")]


def test_fact_table(nodes):
    row = lambda link, k: "<tr><td>" + ("<a href='/d'>D</a>" if link else "D") + "</td>" + "".join(f"<td>{'1,00' + str(i) if i else ''}</td>" for i in range(k)) + "</tr>"
    _, n = nodes("<table><tr><th>h</th></tr>" + row(True, 8) + row(False, 8) + row(True, 7) + "</table>")
    got = P.fact_table(n, [f"c{i}" for i in range(8)]).collect()
    assert len(got) == 1 and (got[0].name, got[0].url, got[0].c0, got[0].c3) == ("D", "/d", "0", "1003")


def test_select_options(nodes):
    html = "<select id='confChurches'><option value='9'>Z</select><select id='confDistricts'><option value=''>pick<option value='1'>North (N)<option value='2'>North<option value='3'></select>"
    _, n = nodes(html, "<select id='confChurches'><option value='9'>Z</option></select>")
    assert sorted((r.page_id, r.id, r.name) for r in P.select_options(n, ["confDistricts", "confChurches"]).collect()) == [(0, "2", "North"), (1, "9", "Z")]


def test_labelled_cells(nodes):
    html = "<table><tr><td data-label='Name'><a href='/1'>One</a></td><td data-label='City'> <b>x</b>Reno </td></tr><tr><td data-label='City'>y</td></tr><tr><td data-label='Name'>Two</td><td data-label='City'><b>z</b></td></tr><tr><td data-label='Name'>Three</td></tr></table>"
    _, n = nodes(html)
    got = P.labelled_cells(n, {"Name": "name", "City": "city"}, "Name", "City").orderBy("row_id").collect()
    assert [(r.url, r.name, r.city) for r in got] == [("/1", "One", "Reno"), (None, "Three", None)]


def test_church_page(nodes):
    html = "<title>T - UMData</title><h1> Grace\nmore </h1><div class='card'><div>Quick Facts (2023)</div><ul><li>Budget: <span>$1,234</span></li><li>Note <span>a, b</span></li><li><span></span></li></ul></div><table id='hci-download'></table>"
    _, n = nodes(html, "<title> Only - UMData </title>")
    got = {r.page_id: r for r in P.church_pages(n).collect()}
    assert (got[0].name, got[0].year, got[0].flag, got[0].facts) == ("Grace", "2023", True, {"Budget": "1234", "Note": "a b"})
    assert (got[1].name, got[1].year, got[1].flag, got[1].facts) == ("Only", None, False, {})
    assert P.page_names(n).filter("page_id = 0").first().heading == "Grace more"


def test_pagers(nodes):
    df, n = nodes(
        "<a class='paginate_button next disabled' href='/d'>Next</a><a class='paginate_button next' href='/n'>x</a>", "<a href='/1'>1</a><a href='/2'>next page</a>",
        "Page 1 of 7", "<a class='page-numbers'>3</a><a class='page-numbers'>12</a>", "<script>$('#t').DataTable({ajax: '/list?x=1'})</script>",
    )
    assert {r.page_id: r.value for r in P.next_links(n).collect()} == {0: "/n", 1: "/2"}
    assert {r.page_id: r.value for r in P.page_counts(df, n).collect()} == {0: 1, 1: 1, 2: 7, 3: 12, 4: 1}
    assert [(r.page_id, r.value) for r in P.ajax_urls(n).collect()] == [(4, "/list?x=1")]


def test_sermon_layouts(nodes):
    a = "<div class='post-single-sermon'><div class='post-single-sermon-header'><h2>Hope</h2><div class='date'> March 5, 2021 </div><strong>Speaker: X</strong><strong>John 1</strong><a rel='tag' href='#'>Ann</a></div><p>One</p><p>Two <i>b</i></p></div>"
    b = "<article class='post tag-news tag-mary-ann-lee'><h1 class='entry-title'>Joy</h1><time datetime='2020-01-02T00:00'>x</time><div class='entry-content'><p>P</p><h3>H</h3><ul><li>no</ul></div></article>"
    df, _ = nodes(a, b, "<p>neither</p>")
    assert [tuple(r) for r in L.sermon_pages(df, "header").collect()] == [("Hope", "2021-03-05", "John 1", "Ann", "One\n\nTwo b", "http://h/0")]
    assert [tuple(r) for r in L.sermon_pages(df, "article").collect()] == [("Joy", "2020-01-02", "", "Mary Ann Lee", "P\n\nH", "http://h/1")]


def test_links_by_section(nodes):
    html = "<a href='/early.pdf'>no</a><h2>S1</h2><table><tr><td><a href='/a.PDF'>A</a><a href='/b.doc'>B</a></td></tr></table><a href='/out.pdf'>out</a><h3>S2</h3><table><tr><td><a href='/a.PDF'>again</a><a href='/c.pdf'> </a><a href='/d.pdf'>D</a></table>"
    n, _ = nodes(html)
    got = sorted((r.section, r.label, r.url) for r in L.links_by_section(n, base="http://b").collect())
    assert got == [("S1", "A", "http://b/a.PDF"), ("S2", "D", "http://b/d.pdf")]


def test_dated_list(nodes):
    html = "<ul><li>before</li></ul><h6>Jan 1</h6><ul><li><strong>Ann,</strong> to Bowie, from Laurel</li><li>no bold</li></ul><h6>Feb 2</h6><ul><li><strong>Bo</strong> to Rome</ul><ol><li><strong>No</strong> to Nowhere</ol>"
    n, _ = nodes(html)
    got = [tuple(r)[1:] for r in L.appointments(n).orderBy("date", "name").collect()]
    assert sorted(got, key=str) == sorted([(None, None, None, None), ("Jan 1", "Ann", "Bowie", "Laurel"), ("Jan 1", None, None, None), ("Feb 2", "Bo", "Rome", None)], key=str)


def test_page_links(nodes):
    html = "<div class='su-tabs-pane'><a href='/1'>a</a><a href='/1'>b</a><div class='su-tabs-pane'><a href='/2'>c</a></div></div><a href='/3'>d</a><h2><a href='/4'>e</a></h2><a href='https://files.ecatholic.com/9/bulletins/x.pdf?y=1'>f</a><a>g</a>"
    n, flat = nodes(html, "<title>Just a moment...</title>")
    assert [r.href for r in L.page_links(n, within_class="su-tabs-pane").orderBy("pos").collect()] == ["/1", "/2"]
    assert [r.href for r in L.page_links(n, parent="h2").collect()] == ["/4"]
    assert [(r.href[:12], r.name, r.blocked) for r in L.bulletin_pages(n).collect()] == [("https://file", "x.pdf", False)]
    assert {r.page_id: r.blocked for r in P.blocked_pages(flat).collect()} == {0: False, 1: True}


def test_deep_and_empty_pages(spark, nodes):
    _, n = nodes("<div>" * 500 + "x", None, "<" * 50, "a < b & c")
    assert n.filter("page_id = 0").agg(F.max("depth")).first()[0] == 499


def test_plain_markup_is_read_like_the_full_parser():
    import random
    import string

    def full(html):
        tree = H._Tree()
        tree.feed(html)
        tree.close()
        tree._close_to(0)
        return tree.rows, tree.strings

    pick = random.Random(3)
    pieces = ["<p>", "</p>", "<td class='a b' id=\"x\">", "<tr>", "</tr>", "<table>", "</table>", "<a href='/x?y=1'>", "</a>", "text", " & ", "&amp;", "&lt;b", "\n", "<br>", "<br/>", "<LI data-x hidden>", "<li", "<!-- c -->", "<title>t</title>", "</p >", "<p a=1>", "<p a='&amp;'>", "<", ">", "<3", "<b></b>", "é", "<p a='' b>", "<ul\n>", "</li x>", "<p a='1'b='2'>", "&am"]
    plain = [p for p in pieces if p not in ("<li", "<", "<3")]
    for turn in range(4000):
        html = "".join(pick.choice(pieces if turn % 2 else plain[:16]) for _ in range(pick.randint(0, 12))) + pick.choice(["", "x", pick.choice(string.printable)])
        tree = H.tree_of(html)
        assert (tree.rows, tree.strings) == full(html), html


def test_records_are_made_where_the_pages_lie(nodes):
    """No element is shuffled, and only what is asked for is parsed."""
    n, _ = nodes(TABLE)
    for made in (L.html_tables(n, links=True), L.sermon_pages(n, "header"), L.sermon_pages(n, "article"), L.links_by_section(n), L.dated_list(n), L.page_links(n, "x"), L.bulletin_pages(n)):
        assert "Exchange" not in made._jdf.queryExecution().executedPlan().toString()
    got = L.html_elements(n, "tr td", "td", "text parent").select(F.inline("els")).collect()
    assert [r.asDict() for r in got][2:4] == [{"at": 2, "end": 2, "tag": "td", "parent": "tr", "text": "A"}, {"at": 3, "end": 3, "tag": "td", "parent": "tr", "text": "B"}]
    assert (got[1].at, got[1].end, got[1].text) == (1, 4, None)


def test_tables_in_tables_and_repeated_headers(nodes):
    html = "<table><thead><tr><th>K<th>K<th>L</thead><tbody><tr><td>1<td>2<td><table><tr><td>in</td></tr></table></td></tr></tbody></table><table><tbody><tr><td>second</tbody></table>"
    n, _ = nodes(html)
    got = [(r.row_idx, r.row) for r in L.html_tables(n).orderBy("row_idx").collect()]
    assert got == [(0, {"K": "2", "L": "in", "Column_3": "in"}), (1, {"K": "in"})]


def test_only_cells_of_tables_leave_the_parser(nodes):
    """A page's other elements, and attributes and texts that no rule of a table asks for, are neither copied nor moved."""
    row = "<tr class='%s'><td data-x='%s'><a href='/p'>P</a> and <b>more</b><td>1/2/2000 - 3/4/2001</tr>" % ("c" * 500, "x" * 500)
    n, _ = nodes("<p>" + "z" * 500 + "</p><table><thead><tr><th>Place<th>Dates</thead><tbody>" + row * 3 + "</tbody></table>", "<p>none</p>")
    made = L.html_tables(n, links=True, base="https://b")
    assert [(r.page_id, r.row_idx) for r in made.orderBy("row_idx").collect()] == [(0, 0), (0, 1), (0, 2)]
    assert made.first().row == {"Place_URL": "https://b/p", "Place": "Pandmore", "Dates": "1/2/2000 - 3/4/2001", "StartDate": "2000-01-02", "EndDate": "2001-03-04"}
    (batch,) = L._table_parser(True)(iter([n.select("page_id", "url", "html").toArrow().combine_chunks().to_batches()[0]]))
    assert batch.schema.names == ["page_id", "names", "rows"]
    assert batch.column(2).to_pylist() == [[[{"text": "Pandmore", "href": "/p"}, {"text": "1/2/2000 - 3/4/2001", "href": None}]] * 3, []]

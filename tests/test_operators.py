"""Operators on small fixtures with their traps: grids, records, survey statistics, areas."""

from __future__ import annotations

import random
import statistics

import pytest
from pyspark.sql import functions as F

from vellum.functions.recode import TRADITION_CODES, recode, tradition
from vellum.operators import county, grid, records, survey


def cells_of(spark, grids):
    rows = [(doc, 1, t, r, c, text) for (doc, t), g in grids.items() for r, row in enumerate(g) for c, text in enumerate(row)]
    return spark.createDataFrame(rows, "doc_id string, page int, table_index int, row_idx int, col_idx int, text string")


GOOD = [["Name", "", "Name", "Total"], ["a", "1,012", "x", "n/a"], [" b ", None, "y", ""], [None, "", "", None]]
GRIDS = {
    ("good", 0): GOOD, ("short", 0): [["h", "k"], ["a", "b"]], ("narrow", 0): [["h"], ["a"], ["b"]], ("graph", 0): [["My Graph", "x"], ["a", "b"], ["c", "d"]],
    ("legend", 0): [["h", "k"], ["a\nb\nc\nd", "b"], ["c", "d"]], ("blank", 0): [["", None], ["", ""], [None, ""]],
    ("long", 0): [["h", "k"], ["a", "b", "c"], ["d", "e"]], ("long", 1): [["h", "k"], ["a", "b"], ["d", "e"]],
}


def test_judge_tables(spark):
    got = {(r.doc_id, r.table_index): (r.ok, r.reason) for r in grid.judge_tables(cells_of(spark, GRIDS)).collect()}
    assert got == {
        ("good", 0): (True, None), ("short", 0): (False, "few rows"), ("narrow", 0): (False, "few columns"), ("graph", 0): (False, "graph header"),
        ("legend", 0): (False, "legend cell"), ("blank", 0): (False, "empty"), ("long", 0): (True, None), ("long", 1): (True, None),
    }


def test_axis_label(spark):
    df = spark.createDataFrame([("a\n b \nc\n  d",), ("a\nbbb\nccc\nd",), ("a\n\nb\nc",), (None,)], "t string")
    assert [r[0] for r in df.select(grid.axis_label("t")).collect()] == [True, False, False, False]


def test_headers_and_records(spark):
    got = grid.grid_to_records(cells_of(spark, {("good", 0): GOOD})).orderBy("row_idx", "col_idx").collect()
    assert [(r.row_idx, r.header, r.value) for r in got] == [
        (1, "Name", "a"), (1, "col_1", "1012"), (1, "Name_1", "x"), (1, "Total", "n/a"), (2, "Name", "b"), (2, "col_1", ""), (2, "Name_1", "y"), (2, "Total", ""),
    ]


def test_header_clash(spark):
    got = grid.headers(cells_of(spark, {("d", 0): [["a", "a", "a_1"], ["1", "2", "3"]]})).orderBy("col_idx").collect()
    assert [(r.header, r.clash) for r in got] == [("a", False), ("a_1", True), ("a_1", True)]


def test_only_the_overlong_table_is_kept_back(spark):
    cells = cells_of(spark, {k: v for k, v in GRIDS.items() if k[0] == "long"})
    assert {(r.doc_id, r.table_index) for r in grid.overlong(cells).collect()} == {("long", 0)}
    assert {(r.doc_id, r.table_index) for r in grid.extract_tables(cells).collect()} == {("long", 1)}
    wide = grid.table_wide(grid.extract_tables(cells), grid.KEY, ["h", "k"]).orderBy("row_idx").collect()
    assert [(r.h, r.k) for r in wide] == [("a", "b"), ("d", "e")]


def test_select_documents(spark):
    docs = spark.createDataFrame([("2024–25", "Annual"), ("2009-10", "Annual"), ("2020–21", "Annual"), ("x", "Other")], "label string, section string")
    done = spark.createDataFrame([("annual_2020-21",)], "section_slug string")
    assert [r.section_slug for r in grid.select_documents(docs, done, "Annual").collect()] == ["annual_2024-25"]


def test_tradition_rules(spark):
    rules = [(c, code) for c, codes in TRADITION_CODES.items() for code in codes]
    assert len(rules) == 66 and len(TRADITION_CODES) == 12
    columns = list(TRADITION_CODES)
    rows = [tuple(code if c == column else None for c in columns) for column, code in rules]
    rows += [tuple(1 for _ in columns), tuple(77 for _ in columns), (None,) * 12]
    df = spark.createDataFrame(rows, ", ".join(f"{c} int" for c in columns)).withColumn("i", F.monotonically_increasing_id())
    got = [r[0] for r in df.orderBy("i").select(tradition()).collect()]
    assert [g.label for g in got[:66]] == [TRADITION_CODES[c][k] for c, k in rules]
    assert [g.ord for g in got[:66]] == list(range(1, 67))
    assert got[66].label == "Southern Baptist" and got[67] is None and got[68] is None


def test_repeated_label_keeps_first_place(spark):
    df = spark.createDataFrame([(2,), (1,)], "a int")
    got = [tuple(r[0]) for r in df.select(recode([("a", 1, "x"), ("a", 2, "x")])).collect()]
    assert got == [("x", 1), ("x", 1)]


def test_weighted_mean_null_rules(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", None, None), ("b", 1.0, None), ("c", None, 1.0)], "g string, x double, w double")
    got = {r.g: r.m for r in df.groupBy("g").agg(survey.weighted_mean("x", "w").alias("m")).collect()}
    assert got == {"a": 1.0, "b": None, "c": None}


def test_quantiles_without_weights_equal_percentile(spark):
    random.seed(3)
    rows = [(g, random.randint(0, 30), 1.0) for g in "ab" for _ in range(57)]
    df = spark.createDataFrame(rows, "g string, x int, w double")
    got = {r.g: (r.q30, r.q50) for r in survey.weighted_quantiles(df, ["g"], "x", "w", [0.3, 0.5]).collect()}
    want = {r.g: tuple(r.p) for r in df.groupBy("g").agg(F.percentile("x", [0.3, 0.5]).alias("p")).collect()}
    for g in want:
        assert got[g] == pytest.approx(want[g])
    assert got["a"][1] == statistics.median(x for g, x, _ in rows if g == "a")


def test_quantiles_drop_null_and_zero_weights(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 9, 0.0), ("a", 9, None), ("a", None, 5.0)], "g string, x int, w double")
    assert survey.weighted_quantiles(df, ["g"], "x", "w", [0.5]).first().q50 == 1.0


def test_mode_takes_the_smallest_on_ties(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("a", 3), ("a", 1), ("b", None)], "g string, x int")
    assert {r.g: r.mode for r in survey.mode_by(df, ["g"], "x").collect()} == {"a": 1, "b": None}
    assert {r.g: r.mode for r in survey.mode_by(df.orderBy(F.desc("x")), ["g"], "x").collect()} == {"a": 1, "b": None}


def test_shares_sum_to_one_with_null_buckets(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), ("a", "y"), ("b", "x")], "g string, b string")
    got = survey.share(df, ["g", "b"], ["g"])
    assert {r.g: r.s for r in got.groupBy("g").agg(F.round(F.sum("pct"), 9).alias("s")).collect()} == {"a": 1.0, "b": 1.0}
    spread = survey.spread_value(got, ["g"], F.col("b") == "y", "pct", "py")
    assert {(r.g, r.py) for r in spread.collect()} == {("a", 1 / 3), ("b", None)}


def test_top_labels_ties_and_prefix(spark):
    df = spark.createDataFrame([("b",), ("a",), ("Other x",), ("Other x",), (None,), ("c",), ("c",)], "t string")
    top = survey.top_labels(df, "t", 2, "Other")
    assert [(r.label, r.n, r["rank"]) for r in top.collect()] == [("c", 2, 1), ("a", 1, 2)]
    assert sorted(r.t for r in survey.keep_labels(df, top, "t").collect()) == ["a", "c", "c"]


def test_reshaping(spark):
    df = spark.createDataFrame([("a", 1, 2)], "g string, x int, y int")
    long = survey.longer(df, ["g"], ["x", "y"])
    assert sorted(tuple(r) for r in long.collect()) == [("a", "x", 1), ("a", "y", 2)]
    assert tuple(survey.wider(long, ["g"], "name", "value", ["x", "y", "z"]).first()) == ("a", 1, 2, None)


def test_first_per_key(spark):
    df = spark.createDataFrame([("k", 2, "b"), ("k", 1, "a"), ("", 1, "x"), (None, 1, "y")], "k string, pos int, v string")
    assert [(r.k, r.v) for r in records.first_per_key(df, "k", ["pos"]).collect()] == [("k", "a")]


def test_append_twice_adds_nothing(spark):
    new = spark.createDataFrame([("u1", 1), ("u1", 2), ("u2", 3)], "url string, n int")
    first = records.append_new(new, new.limit(0), "url", ["n"])
    assert sorted(tuple(r) for r in first.collect()) == [("u1", 1), ("u2", 3)]
    assert records.append_new(new, first, "url", ["n"]).count() == 0


def test_limit_comes_before_resume(spark):
    items = spark.range(10).select(F.col("id").alias("k"))
    done = spark.range(3).select(F.col("id").alias("k"))
    assert sorted(r.k for r in records.todo(items, done, "k", limit=5).collect()) == [3, 4]
    rest = records.todo(items, done, "k")
    assert rest.union(items.join(done, "k", "left_semi")).count() == items.count()


def test_histories_keep_parents_and_entries_win(spark):
    rows = [("1", "u", "Ann", [{"Name": "entry", "Status": "E"}, {"Position": "P"}]), ("2", "v", "Bo", []), ("3", None, "Cy", None)]
    df = spark.createDataFrame(rows, "GCFAId string, URL string, Name string, WorkHistory array<map<string,string>>")
    got = {(r.GCFAId, tuple(sorted(r.record.items(), key=str))) for r in records.merge_histories(df).collect()}
    assert {g for g, _ in got} == {"1", "2", "3"} and len(got) == 4
    first = next(dict(x) for g, x in got if g == "1" and ("Status", "E") in x)
    assert first == {"GCFAId": "1", "URL": "u", "Name": "entry", "Status": "E"}
    assert df.agg(records.entry_total(df, "WorkHistory")).first()[0] == 2


def test_escaped_payloads(spark):
    rows = [("c", "[{&quot;a&quot;: 1}, {&quot;a&quot;: 2}]"), ("d", "{&quot;a&quot;: 1}"), ("e", "[broken"), ("f", None), ("g", "[{&#34;a&#34;: 3}]")]
    df = spark.createDataFrame(rows, "conf_id string, body string")
    assert sorted((r.conf_id, r.a) for r in records.decode_escaped_json(df, "body", "a int").collect() if r.a is not None) == [("c", 1), ("c", 2), ("g", 3)]


def test_envelopes(spark):
    pages = spark.createDataFrame([(0, [1, 2], 3), (1, [3], 3), (2, None, None)], "page int, data array<int>, recordsTotal int")
    assert tuple(records.page_completeness(pages).first()) == (3, 3, True)
    assert [r.item for r in records.concat_pages(pages).orderBy("page", "pos").collect()] == [1, 2, 3]
    body = ['{"items": [{"title": "a"}], "pagination": {"nextPage": true, "nextPageOffset": 5}}', '{"items": [{"title": "b"}]}', '{"items": [], "pagination": {"nextPage": true, "nextPageOffset": 0}}']
    items = records.explode_items(spark.createDataFrame([(b,) for b in body], "body string"), "body", "title: string")
    assert [(r.last_page, r.item and r.item.title) for r in items.collect()] == [(False, "a"), (True, "b"), (True, None)]


def test_entity_chain_and_urls(spark):
    people = spark.createDataFrame([("1",), ("2",)], "GCFAId string")
    histories = spark.createDataFrame([("1", "/church?church=7"), ("1", "/other"), ("1", "/church?church=7")], "GCFAId string, Appointment_URL string")
    churches = spark.createDataFrame([("7", "Grace")], "ChurchId string, ChurchName string")
    chain = records.entity_chain(people, histories, churches)
    assert sorted((r.GCFAId, r.ChurchName) for r in chain.collect() if r.ChurchName) == [("1", "Grace")] * 2
    assert chain.count() == 4
    assert [r.url for r in records.church_urls(histories).collect()] == ["/church?church=7"]


def test_flatten_record_modes(spark):
    df = spark.createDataFrame([("5", [("a", "n"), ("b", None)], None, [])], "GCFAId string, Conferences array<struct<label:string,Name:string>>, x string, y array<string>")
    assert tuple(records.flatten_record(df, "all", "http://h?pastor=").first()) == ("5", "a; b", "", "[]", "http://h?pastor=5")
    assert records.flatten_record(df, "first").first().Conferences == "a"


def test_run_counts(spark):
    df = spark.createDataFrame([("1", [1, 2], None), ("2", None, "failed")], "k string, e array<int>, Error string")
    assert {r.metric: r.n for r in records.run_counts(df, "e", "Error").collect()} == {"entities": 2, "entries": 2, "errors": 1}
    assert [r.failed for r in records.mark_failed(df).orderBy("k").collect()] == [False, True]


def test_county(spark):
    df = spark.createDataFrame([("1", "a", 3), ("1", "b", 1), ("1", "c", 0), ("2", "a", 5)], "fips string, g string, n int")
    got = {r.fips: r for r in county.county_diversity(df, "fips", "g", "n").collect()}
    assert (got["1"].groups, got["1"].largest_share, round(got["1"].simpson, 6)) == (2, 0.75, 0.375)
    assert got["2"].shannon == 0
    a, b = (spark.createDataFrame(x, "fips string, n int") for x in ([("1", 10), ("2", 0)], [("1", 15), ("2", 5), ("3", 1)]))
    assert {r.fips: r.change for r in county.wave_change(a, b, ["fips"], "n").collect()} == {"1": 0.5, "2": None, "3": None}
    assert [r[0] for r in spark.createDataFrame([("-9",), (" ",), ("12",), (None,)], "x string").select(county.known("x")).collect()] == [None, None, 12.0, None]
    line = spark.createDataFrame([(1.0, 3.0), (2.0, 5.0), (3.0, 7.0)], "x double, y double")
    assert all(abs(r.residual) < 1e-9 for r in county.regress_residuals(line, "y", "x").collect())
    rate = county.adjusted_rate(spark.createDataFrame([("a", "50", "100"), ("b", "-9", "100")], "g string, adh string, pop string"), spark.createDataFrame([("a", 1.2)], "g string, factor double"), "g", "adh", "pop")
    assert {r.g: (r.rate, r.adjusted) for r in rate.collect()} == {"a": (0.5, 0.6), "b": (None, None)}
    assert spark.range(1).select(county.fips(F.lit(1001))).first()[0] == "01001"


def test_small_record_helpers(spark):
    items = spark.createDataFrame([("1", "c1"), ("2", "c9")], "id string, conf string")
    dim = spark.createDataFrame([("c1", "North")], "conf string, name string")
    assert {r.id: r.name for r in records.tag(items, dim, "conf").collect()} == {"1": "North", "2": None}
    assert [r.id for r in records.first_n(items, 1, ["id"]).collect()] == ["1"]
    assert {r.conf: r.n for r in survey.count_by(items.union(items), "conf").collect()} == {"c1": 2, "c9": 2}
    wide = survey.facts_wide(spark.createDataFrame([("1", {"a": "x"})], "id string, facts map<string,string>"), "facts", ["a", "b"])
    assert tuple(wide.first()) == ("1", "x", None)
    both = survey.union_all(items, dim, missing=True)
    assert both.columns == ["id", "conf", "name"] and both.count() == 3


def test_order_of_labels_with_missing_statistics(spark):
    df = spark.createDataFrame([("a", 2.0), ("b", None), ("c", 1.0), (None, 3.0)], "t string, x double")
    assert {r.t: r.ord for r in survey.order_by_stat(df, "t", "x").collect()} == {"c": 1, "a": 2, None: 3, "b": 4}
    assert {r.t: r.ord for r in survey.order_by_stat(df, "t", "x", ascending=False).collect()} == {None: 1, "a": 2, "c": 3, "b": 4}


def test_carry_forward_keeps_rows_before_the_first_heading(spark):
    df = spark.createDataFrame([(1, None), (2, "h"), (3, None), (4, "k")], "i int, h string")
    assert [r.h for r in records.carry_forward(df.withColumn("g", F.lit(1)), "h", ["g"], ["i"]).orderBy("i").collect()] == [None, "h", "h", "k"]


def test_large_dimensions_are_not_broadcast(spark):
    df = spark.range(50)
    assert "broadcast" in survey.broadcast_if_small(df, 50)._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in survey.broadcast_if_small(df, 49)._jdf.queryExecution().logical().toString().lower()


def test_survey_reports_on_a_few_people(spark):
    from vellum.plans import reports

    rows = [(2023, 1940, 1.0, 1), (2023, 2000, 3.0, 1), (2022, None, 1.0, 1), (2009, 1980, 1.0, 1), (2024, 1950, 1.0, 2), (2024, 1990, 1.0, 90)]
    columns = list(TRADITION_CODES)
    df = spark.createDataFrame(rows, "year int, birthyr int, weight double, baptist int")
    for c in columns[1:]:
        df = df.withColumn(c, F.lit(None).cast("int"))
    got = reports.all_reports(df)
    assert {r.trad for r in got["age_shares"].collect()} == {"Southern Baptist", "ABCUSA"}
    shares = {(r.period, r.trad): r.pct_18_40 for r in got["young_shares"].collect()}
    assert shares == {("2022–2024", "Southern Baptist"): 0.75, ("2022–2024", "ABCUSA"): 0.0, ("2008–2010", "Southern Baptist"): 1.0}
    assert {r.trad: r.pct_boomer for r in got["boomer_shares"].collect()} == {"Southern Baptist": 0.0, "ABCUSA": 1.0}
    assert {(r.trad, r.stat): r.age for r in got["age_stats"].collect()} == {("Southern Baptist", "mean_age"): 54.0, ("Southern Baptist", "mode_age"): 24.0, ("ABCUSA", "mean_age"): 74.0, ("ABCUSA", "mode_age"): 74.0}
    years = {(r.trad, r.threshold): r.death_year for r in got["years_left"].collect()}
    assert years["ABCUSA", "50%"] == 2024 + 85 - 74

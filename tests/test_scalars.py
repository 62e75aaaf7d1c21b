"""Golden cases of the column functions, with the traps of missing, empty and odd text."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from vellum.functions import scalars as S


def values(spark, column, texts, name="t"):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, {name} string")
    return [r[0] for r in df.orderBy("i").select(column.alias("x")).collect()]


CASES = [
    ("strip_commas", lambda: S.strip_commas("t"), ["1,012", "1,0a", "", None, "-", "1,234.5", "nan", "1_0", "1d", "12%"], ["1012", "1,0a", "", None, "-", "1234.5", "nan", "1_0", "1d", "12%"]),
    ("count_text", lambda: S.count_text("t"), ["1,200", "", None, " 7 "], ["1200", "0", "0", "7"]),
    ("fact_value", lambda: S.fact_value("t"), ["$1,234", "a, b", "$5"], ["1234", "a b", "5"]),
    ("start_year", lambda: S.start_year("t"), ["2024–25", "yr 201", "2010-11"], [2024, 0, 2010]),
    ("mdy_iso", lambda: S.mdy_iso("t"), ["1/2/2020", "1 / 2\n/ 2020", "123/4/2020", " 2020 ", "", None], ["2020-01-02", "2020-01-02", "2020-123-04", " 2020 ", None, None]),
    ("label_slug", lambda: S.label_slug("t"), ["2024–25", " A/B—C "], ["2024-25", "a-b-c"]),
    ("drop_abbrev", lambda: S.drop_abbrev("t"), ["North Texas (NTX)", "A (b) c"], ["North Texas", "A (b) c"]),
    ("slug", lambda: S.slug("t", keep_dot=True, max_len=10), ["Café au lait!", "a  b.c", "x" * 20], ["Café_au_la", "a_b.c", "x" * 10]),
    ("id_from_url", lambda: S.id_from_url("t", "pastor"), ["/x?pastor=12&y=1", "/x"], ["12", None]),
    ("absolutise", lambda: S.absolutise("t", "https://h"), ["/a", "http://b", "", None], ["https://h/a", "http://b", "", None]),
    ("file_title", lambda: S.file_title("t", F.lit(None).cast("date")), ["Kettering_Baptist_-_Hope_and-joy", "Kettering_Bap_", "plain"], ["Hope and joy", None, "plain"]),
    ("decoded", lambda: S.decoded("t"), ["a%20b+c"], ["a b+c"]),
    ("wrap", lambda: S.wrap("t", 6), ["aa bb cc", "abcdefgh x", ""], ["aa bb\ncc", "abcdefgh\nx", ""]),
    ("unescape", lambda: S.unescape("t"), ["&lt;a&gt; &quot;b&quot; &amp;lt;"], ['<a> "b" &lt;']),
    ("unescape_all", lambda: S.unescape_all("t"), ["&eacute;&#233; &amp;quot;", None], ["éé &quot;", None]),
]


@pytest.mark.parametrize("name,column,texts,want", CASES, ids=[c[0] for c in CASES])
def test_text_function(spark, name, column, texts, want):
    assert values(spark, column(), texts) == want


def test_file_date_patterns(spark):
    got = values(spark, S.file_date("t"), ["talk 1-2-2020", "x 01.02.20", "x 1-2-49", "a 010250", "b 01022020", "13-45-2020 then 010220", "Bap_01-02-2020", "none", "0-0-0000"])
    day = datetime.date
    assert [tuple(g) for g in got] == [(day(2020, 1, 2), 1), (day(2020, 1, 2), 2), (day(2049, 1, 2), 3), (day(1950, 1, 2), 4), (day(2020, 1, 2), 5), (day(2020, 1, 2), 4), (None, None), (None, None), (None, None)]


def test_iso_file_date(spark):
    got = values(spark, S.file_date("t", S.ISO_FILE_DATES), ["2020-02-30 x", "x 2020.02.03", "20200203"])
    assert [g["date"] for g in got] == [None, datetime.date(2020, 2, 3), None]


def test_text_date(spark):
    got = values(spark, S.text_date("t"), [" March 5, 2021 ", "Mar. 5, 2021", "March 2021", "Lent", "March 5,\n 2021", "March  5, 2021", "On  March 5, 2021"])
    assert [g["raw"] for g in got] == ["2021-03-05", "2021-03-05", "2021-03-01", "Lent", "2021-03-05", "2021-03-05", "On  March 5, 2021"]
    other = values(spark, S.text_date("t", S.PAGE_DATES_B), ["Mar 5, 2021", "2021-3-5"])
    assert [g["raw"] for g in other] == ["2021-03-05", "2021-03-05"]


def test_date_range(spark):
    got = values(spark, S.date_range("t"), ["1/2/2020 - 3/4/2021", "1/2/2020 - present", "1/2/2020", "1-2-2020", "", "1/2/2020 -", "- 1/2/2020", " 1 / 2 / 2020\n- 3 /4/ 2021 ", None])
    assert [tuple(g) for g in got] == [("2020-01-02", "2021-03-04"), ("2020-01-02", None), ("2020-01-02", None), ("1-2-2020", None), (None, None), ("2020-01-02", None), (None, "2020-01-02"), ("2020-01-02", "2021-03-04"), (None, None)]


def test_transcript(spark):
    text = "- Speaker 2: Hello [music\nplays] all (aside) ♪ la ♪\n# sung\nbye - bye"
    assert values(spark, S.clean_transcript("t"), [text, ""]) == ["Hello all la bye - bye", ""]


def test_parse_move(spark):
    df = spark.createDataFrame([("Ann Lee, to Bowie, from Laurel", "Ann Lee,"), ("Bo to Rome", "Bo"), ("to Oz", None)], "t string, b string")
    got = [tuple(r[0]) for r in df.select(S.parse_move("t", "b")).collect()]
    assert got == [("Ann Lee", "Bowie", "Laurel"), ("Bo", "Rome", None), (None, None, None)]


def test_lists(spark):
    df = spark.createDataFrame([([("a", "x"), ("", "y")],), ([],), (None,)], "v array<struct<label:string,Name:string>>")
    assert [r[0] for r in df.select(S.list_text("v")).collect()] == ["a; y", "[]", ""]
    assert [r[0] for r in df.select(S.list_text("v", mode="first")).collect()] == ["a", "[]", ""]


def test_query_params(spark):
    got = values(spark, S.query_params("t"), ["http://h/p?a=1&b=x%20y&a=2&c", "http://h/p"])
    assert got == [{"a": "1", "b": "x y"}, {}]


def test_audio_and_file_names(spark):
    df = spark.createDataFrame([(None, "http://h/a.mp3", "", "T"), ("x.wav", None, 'data-url="https://h/My%20talk+1.mp3?x=1"', "T"), (None, None, None, "Grace & Hope")], "a string, b string, body string, title string")
    url = S.audio_url("a", "b", "body")
    got = df.select(url.alias("u"), S.file_from_url(url, "title").alias("f"), S.file_from_url(F.lit("http://h/x"), "title").alias("g")).collect()
    assert [r.u for r in got] == ["http://h/a.mp3", "https://h/My%20talk+1.mp3?x=1", None]
    assert [r.f for r in got][:2] == ["a.mp3", "My talk+1.mp3"]
    assert got[2].g == "Grace_Hope.mp3"


def test_survey_values(spark):
    df = spark.createDataFrame([(17,), (18,), (29,), (75,), (101,), (None,)], "a int")
    got = df.select(S.bucket("a", S.AGE_BREAKS, S.AGE_LABELS)["label"].alias("b"), S.clamp("a", 18, 100).alias("c"), S.years_left("a").alias("y"), S.cohort_flag(1950 + F.col("a") * 0).alias("f")).collect()
    assert [r.b for r in got] == [None, "18–29", "18–29", "75+", "75+", None]
    assert [r.c for r in got] == [18, 18, 29, 75, 100, None]
    assert [r.y for r in got] == [67, 67, 56, 10, 0, None]
    assert [r.f for r in got] == [1, 1, 1, 1, 1, 0]
    assert [r[0] for r in spark.range(1).select(S.percent_text(F.lit(0.125))).collect()] == ["12%"]
    assert spark.range(1).select(S.relabel(F.lit("a"), {"a": "b"}), S.period(F.lit(2023), {"then": (2008, 2010), "now": (2022, 2024)}), S.age(2024, F.lit(2000)), S.calendar_year(F.lit(6)), S.pivot_year(F.lit("50"))).first()[:] == ("b", "now", 24, 2030, 1950)


def test_white_space_of_every_script_goes(spark):
    df = spark.createDataFrame([("\n \tMarch 5, 2021  \n",)], "t string")
    got = df.select(S.strip("t").alias("s"), S.text_date("t")["raw"].alias("d"), S.slug(F.lit("A B  c")).alias("g"), S.count_text(F.lit("\n1,234\t")).alias("n"), S.label_slug(F.lit(" 2020–21\n")).alias("l")).first()
    assert tuple(got) == ("March 5, 2021", "2021-03-05", "A_B_c", "1234", "2020-21")
    move = df.select(S.parse_move(F.lit("\n A B,\n\t to X, from\nY\n"), F.lit("A B,")).alias("m")).first().m
    assert (move.name, move.to, move["from"]) == ("A B", "X", "Y")
    span = df.select(S.date_range(F.lit("\n1/2/2020 -\n Present\n")).alias("r")).first().r
    assert (span.start, span.end) == ("2020-01-02", None)


def test_days_that_do_not_exist_are_null(spark):
    df = spark.createDataFrame([("x 02-30-2020", "2-29-24"), ("x 13-01-2020", "2-29-23")], "a string, b string")
    assert [(r[0], str(r[1])) for r in df.select(S.file_date("a")["date"], S.file_date("b")["date"]).collect()] == [(None, "2024-02-29"), (None, "None")]

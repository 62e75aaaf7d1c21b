"""Sources, sinks and ingest on files made for the test, and the published table corpus where it is present."""

from __future__ import annotations

import csv
import os

import pytest
from pyspark.sql import functions as F

from vellum.operators import grid
from vellum.sources import readers, sinks
from vellum.streaming.ingest import ingest_available, ingest_json

CORPUS = os.environ.get("TABLE_CORPUS", "")


def test_table_corpus(spark, tmp_path):
    folder = tmp_path / "annual_2020-21"
    folder.mkdir()
    rows = [["Name", "col_1", "x"], ["a\nb", "1,2", 'say "hi"'], ["", "", "last"]]
    with (folder / "page_3_table_0.csv").open("w", newline="") as file:
        csv.writer(file).writerows(rows)
    got = readers.read_table_cells(spark, str(tmp_path)).orderBy("row_idx", "col_idx").collect()
    assert {(r.section, r.year_slug, r.page, r.table_index) for r in got} == {("annual", "2020-21", 3, 0)}
    assert [[r.text for r in got if r.row_idx == i] for i in range(3)] == rows
    body = readers.read_table_corpus(spark, str(tmp_path)).filter("row_idx = 0").orderBy("col_idx").collect()
    assert [(r.header, r.text) for r in body] == [("Name", "a\nb"), ("col_1", "1,2"), ("x", 'say "hi"')]


def test_tables_of_any_width(spark, tmp_path):
    """Rows keep their own length, wide ones and short ones, over many chunks; empty lines are left out; odd bytes stay readable."""
    folder = tmp_path / "in" / "annual_2020-21"
    folder.mkdir(parents=True)
    tables = {0: [[f"h{i}" for i in range(20)], [str(i) for i in range(20)], ["a"], ["", "b"], [str(i) for i in range(500)]], 1: [["x", "y"]] + [[str(i), "q" * 50] for i in range(30_000)], 2: [["only"]]}
    for t, rows in tables.items():
        with (folder / f"page_1_table_{t}.csv").open("w", newline="") as file:
            csv.writer(file).writerows(rows)
    (folder / "page_1_table_3.csv").write_bytes(b"\xef\xbb\xbfh\xff\n\n\n\"x\ny\"\n")
    (folder / "page_1_table_4.csv").write_bytes(b"")
    cells = readers.read_table_cells(spark, str(tmp_path / "in"))
    got = {}
    for r in cells.collect():
        got.setdefault(r.table_index, {}).setdefault(r.row_idx, {})[r.col_idx] = r.text
    made = {t: [[row[c] for c in sorted(row)] for _, row in sorted(rows.items())] for t, rows in got.items()}
    assert made == tables | {3: [["h\ufffd"], ["x\ny"]]}
    body = readers.read_table_corpus(spark, str(tmp_path / "in")).filter("table_index = 0 and row_idx = 3").orderBy("col_idx").collect()
    assert [r.header for r in body] == [f"h{i}" for i in range(20)] + [None] * 480
    assert "Exchange" not in readers.read_table_corpus(spark, str(tmp_path / "in"))._jdf.queryExecution().executedPlan().toString()


def test_table_files_appear_at_once(spark, tmp_path):
    """Many tables from several tasks; a second write replaces them; a write that fails leaves what was there and nothing else."""
    path = f"file://{tmp_path}/out"
    rows = spark.range(6_000).select(F.lit("a").alias("section"), (F.col("id") % 3).cast("string").alias("year_slug"), (F.col("id") % 1_000).cast("int").alias("page"), F.lit(0).alias("table_index"), "id", (-F.col("id")).alias("row_idx"), F.concat(F.lit('"é,\n'), F.col("id").cast("string")).alias("v"))
    sinks.write_table_files(rows, path, ["id", "v"])
    names = sorted(str(p.relative_to(tmp_path)) for p in tmp_path.rglob("*.csv"))
    assert len(names) == 3_000 and names[0] == "out/a_0/page_0_table_0.csv" and os.listdir(tmp_path) == ["out"]
    want = {}
    for i in sorted(range(6_000), reverse=True):
        want.setdefault((i % 3, i % 1_000), []).append([str(i), f'"é,\n{i}'])
    for (year, page), table in list(want.items())[::37]:
        assert list(csv.reader((tmp_path / f"out/a_{year}/page_{page}_table_0.csv").open(newline="", encoding="utf-8"))) == table
    bad = rows.withColumn("v", F.when(F.col("id") == 5_999, F.raise_error(F.lit("broken"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="broken"):
        sinks.write_table_files(bad, path, ["id", "v"])
    assert os.listdir(tmp_path) == ["out"] and len(list(tmp_path.rglob("*.csv"))) == 3_000
    sinks.write_table_files(rows.filter("page = 7"), path, ["id"])
    assert len(list(tmp_path.rglob("*"))) == 1 + 3 + 3


@pytest.mark.skipif(not os.path.isdir(CORPUS), reason="TABLE_CORPUS names no folder of the published corpus")
def test_published_corpus(spark):
    cells = readers.read_table_cells(spark, CORPUS).cache()
    key = ["section", "year_slug", "page", "table_index"]
    files = [os.path.join(d, f) for d, _, fs in os.walk(CORPUS) for f in fs if f.endswith(".csv")]
    plain = sum(len(row) for f in files for row in list(csv.reader(open(f, newline="")))[1:])
    assert cells.select(*key).distinct().count() == len(files) == 507
    assert cells.filter("row_idx > 0").count() == plain == 68313
    assert cells.filter("row_idx > 0").select(*key, "row_idx").distinct().count() == 11181
    assert grid.judge_tables(cells, key).filter("not ok").count() == 0
    from vellum.functions import scalars as S

    assert cells.filter(S.strip_commas("text") != F.col("text")).filter("row_idx > 0").count() == 0
    cells.unpersist()


def test_text_corpus(spark, tmp_path):
    (tmp_path / "a b+c%20.txt").write_bytes(b" hi \xff there\n")
    (tmp_path / "_skip.txt").write_text("no")
    (tmp_path / "x.md").write_text("no")
    got = readers.read_text_corpus(spark, str(tmp_path), "kettering").collect()
    assert [r.full_text for r in got] == ["hi � there"]
    assert got[0].file_name.startswith("a b+c") and got[0].source_key == f"file://kettering/{got[0].file_name}"


def test_feed(spark, tmp_path):
    (tmp_path / "f.xml").write_text("<rss><channel><item><title>One</title><enclosure url='http://a.mp3'/></item><item><title>Two</title></item><item><enclosure url='http://c.mp3'/></item></channel></rss>")
    got = readers.read_feed(spark, str(tmp_path / "f.xml")).orderBy("pos").collect()
    assert [tuple(r) for r in got] == [(0, "One", "http://a.mp3"), (2, "episode_2", "http://c.mp3")]


def test_records_and_done(spark, tmp_path):
    (tmp_path / "r").mkdir()
    (tmp_path / "r" / "1.json").write_text('{"id": "1"}')
    (tmp_path / "r" / "all.json").write_text('[{"id": "9"}]')
    assert [r.id for r in readers.read_records(spark, str(tmp_path / "r"), "id string", exclude="all.json").collect()] == ["1"]
    (tmp_path / "done.txt").write_text("a\n b \n\na\n")
    assert sorted(r.key for r in readers.read_done(spark, str(tmp_path / "done.txt")).collect()) == ["a", "b"]


def test_union_csv(spark, tmp_path):
    df = spark.createDataFrame([({"b": "1", "id": "x"},), ({"a": "2,3", "id": "y"},)], "record map<string,string>")
    sinks.write_union_csv(df, str(tmp_path / "o"), lead=("id",))
    back = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "o"))
    assert back.columns == ["id", "a", "b"]
    assert sorted(tuple(x or "" for x in r) for r in back.collect()) == [("x", "", "1"), ("y", "2,3", "")]


def test_sections_tables_json(spark, tmp_path):
    df = spark.createDataFrame([("1", "n")], "id string, name string")
    sinks.write_sections({"a": df, "b": df}, str(tmp_path / "s"))
    assert spark.read.json(str(tmp_path / "s/a")).count() == 1
    assert {r.section for r in spark.read.json(str(tmp_path / "s/all")).collect()} == {"a", "b"}
    sinks.write_json(df, str(tmp_path / "j"), "id", "http://h?id=")
    assert spark.read.json(str(tmp_path / "j")).first().URL == "http://h?id=1"
    cells = spark.createDataFrame([("s", "y", 1, 0, 0, 0, "t")], "section string, year_slug string, page int, table_index int, row_idx int, col_idx int, text string")
    sinks.write_tables(cells, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).filter("section = 's' and year_slug = 'y'").count() == 1
    sinks.write_text_table(df, str(tmp_path / "x"))
    assert readers.read_survey(spark, str(tmp_path / "x")).count() == 1


def test_append_is_idempotent(spark, tmp_path):
    new = spark.createDataFrame([("u1", 1), ("u2", 2), ("u1", 3)], "url string, n int")
    target = str(tmp_path / "t")
    assert sinks.append_new_to(target, new, "url", ["url", "n"]) == {"imported": 2, "skipped": 1}
    assert sinks.append_new_to(target, new, "url", ["url", "n"]) == {"imported": 0, "skipped": 3}
    assert sorted(tuple(r) for r in spark.read.parquet(target).collect()) == [("u1", 1), ("u2", 2)]


def test_restartable_ingest(spark, tmp_path):
    folder, check, target = tmp_path / "in", str(tmp_path / "c"), str(tmp_path / "t")
    folder.mkdir()

    def run():
        query = ingest_available(spark, str(folder), check, target)
        query.awaitTermination()
        return spark.read.parquet(target).count()

    (folder / "a.txt").write_text("one\nline")
    (folder / "b.txt").write_text("two")
    assert run() == 2
    assert run() == 2
    (folder / "c.txt").write_text("three")
    assert run() == 3
    assert {r.full_text for r in spark.read.parquet(target).collect()} == {"one\nline", "two", "three"}


def test_a_killed_batch_is_run_again(spark, tmp_path):
    """A batch that wrote its rows but was never committed leaves no row twice, and keys of earlier batches stay known."""
    folder, check, target = tmp_path / "in", tmp_path / "c", str(tmp_path / "t")
    folder.mkdir()

    def add(name, rows):
        (folder / name).write_text("".join(f'{{"k": "{k}", "v": {v}}}\n' for k, v in rows))

    def run():
        query = ingest_json(spark, str(folder), str(check), target, "k string, v int", "k")
        query.awaitTermination()
        return sorted((r.k, r.v) for r in spark.read.parquet(target).collect()), query.lastProgress

    add("a.json", [("1", 1), ("2", 2)])
    run()
    add("b.json", [("2", 20), ("3", 3), ("4", 4)])
    want = [("1", 1), ("2", 2), ("3", 3), ("4", 4)]
    assert run()[0] == want
    last = max((p for p in (check / "commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    for p in (last, check / "commits" / f".{last.name}.crc"):
        p.unlink(missing_ok=True)
    assert run()[0] == want
    add("c.json", [("1", 9), ("5", 5)])
    rows, progress = run()
    assert rows == [*want, ("5", 5)]
    assert "rocksdb" in progress.json and spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


def test_json_ingest(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"k": "1", "v": 2}\n{"k": "1", "v": 3}\n')
    ingest_json(spark, str(tmp_path / "in"), str(tmp_path / "c"), str(tmp_path / "t"), "k string, v int", "k").awaitTermination()
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1


def test_text_files_are_written_by_many_tasks(spark, tmp_path):
    """One file a row, also for rows that came in one partition, and each row once."""
    rows = spark.range(40).select(F.concat(F.lit("t"), F.col("id").cast("string")).alias("value")).coalesce(1)
    sinks.write_text_files(rows, f"{tmp_path}/texts")
    files = list((tmp_path / "texts").glob("part-*.txt"))
    assert sorted(f.read_text() for f in files) == sorted(f"t{i}\n" for i in range(40))
    assert len({f.name.split("-")[1] for f in files}) > 4

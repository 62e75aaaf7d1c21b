"""Records of differing keys, and pages read until they end."""

from __future__ import annotations

import csv
import glob

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.operators import open_records as O
from vellum.operators import records, survey
from vellum.sources import sinks

TEXTS = [
    r'''{"a":1,"b c":{"x":[1,2]},"q`'\"z":null,"":"e","l":[]}''', '{"a":"t","A":2.5,"OBJECT<":[{"label":"u"},3,{"label":"","Name":"n"},{"z":1},null]}',
    "[1]", "nope", None, '{"a":1,"a":2}', '{"a":null,"date":"x","9":true,"f":{}}',
]


@pytest.fixture
def rows(spark):
    return O.parse_records(spark.createDataFrame(list(enumerate(TEXTS)), "id int, j string"), "j")


def test_types_of_all_rows(spark, rows):
    found = O.found_types(rows)
    assert found.names == ["", "9", "A", "OBJECT<", "a", "b c", "date", "f", "l", "q`'\"z"]
    assert found["a"].dataType == T.VariantType() and found["b c"].dataType["x"].dataType == T.ArrayType(T.LongType())
    assert O.found_types(rows.limit(0)) == O.found_types(rows.filter("id between 2 and 5")) == T.StructType()


def test_text_table(rows):
    got = {r.id: r.asDict() for r in O.text_table(rows, lead=("zz", "a"), keep=("id",)).collect()}
    assert list(got[0])[:3] == ["id", "zz", "a"] and len(got) == 7
    assert (got[0]["a"], got[0]["b c"], got[0]["l"], got[0][""], got[0]["q`'\"z"]) == ("1", '{"x":[1,2]}', "[]", "e", "")
    assert (got[1]["a"], got[1]["A"], got[1]["OBJECT<"]) == ("t", "2.5", 'u; 3; n; {"z":1}')
    assert all(set(v for k, v in got[i].items() if k != "id") == {""} for i in (2, 3, 4, 5))
    assert (got[6]["a"], got[6]["9"], got[6]["f"]) == ("", "true", "{}")


def test_first_item_only(spark):
    df = O.parse_records(spark.createDataFrame([('{"k":[{"label":"u"},3]}',), ('{"k":[null,3]}',), ('{"k":[]}',), ('{"k":[[1],2]}',)], "j string"), "j")
    assert [r.k for r in O.text_table(df, mode="first").collect()] == ["u", "", "[]", "[1]"]


def test_typed_table_keeps_nested_values(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    df = O.typed_table(rows.filter("id <> 1"), keep=("id",))  # without the key that differs in case only
    df.write.parquet(path)
    got = {r.id: r for r in spark.read.parquet(path).collect()}
    assert got[0]["b c"].x == [1, 2] and got[0].l == [] and got[0].a == 1 and got[6]["9"] is True and got[6].a is None
    assert got[6].f.toPython() == {} and all(v is None for k, v in got[3].asDict().items() if k != "id")


def test_unite_tables_of_other_columns_and_types(spark):
    a = spark.range(2).select("id", F.array("id").alias("n"))
    b = spark.createDataFrame([(None, "q"), ("x", None)], "id string, r string")
    assert [r.record.toPython() for r in O.unite_records(a, b).collect()] == [{"id": 0, "n": [0]}, {"id": 1, "n": [1]}, {"r": "q"}, {"id": "x"}]
    assert O.as_records(b, keep=("r",), drop_null=False).filter("r = 'q'").first().record.toPython() == {"id": None}


def test_keys_that_differ_in_case(spark, tmp_path):
    df = spark.createDataFrame([({"a": "1", "A": "2"},), ({"b": 'x",\n'},), ({},), (None,)], "record map<string,string>")
    sinks.write_union_csv(df.coalesce(1), str(tmp_path / "o"))
    with open(glob.glob(str(tmp_path / "o" / "*.csv"))[0], newline="") as file:
        assert list(csv.reader(file)) == [["A", "a", "b"], ["2", "1", ""], ["", "", 'x",\n'], ["", "", ""], ["", "", ""]]
    assert spark.conf.get("spark.sql.caseSensitive") == "false"


def test_keys_of_a_map_found(spark):
    df = spark.createDataFrame([(1, {"b": 2}), (2, {"a": 1}), (3, None)], "id int, facts map<string,int>")
    assert [tuple(r) for r in survey.facts_wide(df, "facts").orderBy("id").collect()] == [(1, None, 2), (2, 1, None), (3, None, None)]
    assert survey.facts_wide(df, "facts").columns == ["id", "a", "b"]


def plain_pages(pages, length):
    """A reader's loop over the pages of one key."""
    out = []
    for page, data, total in sorted(pages):
        out += [(page, i, x) for i, x in enumerate(data or [])]
        if not data or (page - 1) * length + len(data) >= (total or 0):
            break
    return out


@pytest.mark.parametrize("keys", [("k",), ()])
def test_pages_end(spark, keys):
    made = {
        "full": [(1, [1, 2], 5), (2, [3, 4], 5), (3, [5], 5), (4, [6], 5)], "empty": [(1, [1, 2], 9), (2, [], 9), (3, [3], 9)], "none": [(1, [1, 2], 9), (2, None, 9), (3, [3], 9)],
        "no total": [(1, [1], None), (2, [2], 9)], "short": [(1, [1, 2], 9), (2, [3], 9)], None: [(1, [7], 1), (2, [8], 9)],
    }
    for group in [made] if keys else [{k: v} for k, v in made.items()]:
        df = spark.createDataFrame([(k, *p) for k, ps in group.items() for p in ps], "k string, page int, data array<int>, total int")
        got = records.concat_pages(df, keys=keys, total_col="total", length=2)
        want = [((k,) if keys else ()) + r for k, ps in group.items() for r in plain_pages(ps, 2)]
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)

"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import decimal

import duckdb
import pytest

from vellum.plans import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return float(f"{value:.9g}")
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_sql():
    assert set(catalogue.QUERIES) == set(catalogue.ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(name, spark, sf_dir, duck):
    df = catalogue.QUERIES[name](spark, sf_dir)
    want = duck.execute(catalogue.ORACLE_SQL[name])
    columns = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, want.fetchall())


@pytest.mark.parametrize("name", ["page_title_h1", "page_list_items"])
def test_sql_decodes_every_character_reference(name, spark, tmp_path):
    """Titles cut behind ``&amp`` and the like: references without a semicolon, by number and by any name, as the parser reads them."""
    texts = ["and&amp", "a &quot;b&quot; &am", "&nbsp;x&notit;y &#8211; &#x41;&#150;", " two\n lines &eacute;&copy", "&#0;&bogus; & &"]
    htmls = [f'<html><title>{t}</title><body><h1>{t}</h1><ul><li><a href="/x">{t}</a></li></ul></body></html>' for t in texts] + ["<title>only - UMData</title>"]
    spark.createDataFrame([(i, f"http://h/{i}", h) for i, h in enumerate(htmls)], "page_id bigint, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    df, want = catalogue.QUERIES[name](spark, str(tmp_path)), con.execute(catalogue.ORACLE_SQL[name])
    columns = [d[0] for d in want.description]
    assert rows_of(df.columns, df.collect()) == rows_of(columns, want.fetchall())

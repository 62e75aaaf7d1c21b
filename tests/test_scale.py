"""Filters before joins, and groups that hold all rows."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from vellum.operators import bloom, records, running, survey


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_finds_all_keys_and_few_others(spark):
    keys = spark.range(0, 60_000, 3).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"))
    keys = keys.union(spark.createDataFrame([(None,)], "key string")).union(keys.limit(100))
    slices = bloom.slices_for(20_000) + 2
    rows = spark.range(60_000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"), "id").union(spark.createDataFrame([(None, -1)], "key string, id bigint"))
    got = bloom.with_hits(rows, "key", bloom.bloom_filter(keys, "key", slices), slices)
    assert got.columns == ["key", "id", "_hit"] and got.count() == 60_001
    assert got.filter("id % 3 = 0 and not _hit").count() == 0
    assert got.filter("id % 3 <> 0 and _hit").count() < 400
    assert got.filter("key is null and _hit").count() == 0
    words = bloom.bloom_filter(keys.limit(0), "key", 1).first()._words
    assert len(words) == bloom.SLICE // 64 and not any(words)


@pytest.mark.parametrize("few", [0, 100_000])
def test_anti_join_behind_a_filter(spark, monkeypatch, few):
    """Equal to the plain anti-join; with a filter only possible hits meet the list in a shuffle."""
    monkeypatch.setattr(bloom, "FEW", few)
    rows = spark.range(5_000).select(F.when(F.col("id") % 11 > 0, F.col("id") % 900).alias("key"), "id", F.lit(1).alias("_done"))
    done = spark.createDataFrame([(i,) for i in range(0, 900, 2)] * 3 + [(None,)], "key bigint")
    want = sorted(tuple(r) for r in rows.select("id").join(rows.join(done, "key", "left_semi").select("id"), "id", "left_anti").collect())
    got = bloom.without(rows.drop("_done"), done, "key")
    assert got.columns == ["key", "id"] and sorted((r.id,) for r in got.collect()) == want
    if not few:
        assert plan_of(got).count("BroadcastHashJoin") >= 2  # the filter, for those that pass and for possible hits
        passing = plan_of(bloom.with_hits(rows, "key", bloom.bloom_filter(done, "key", 1), 1).filter("not _hit"))
        assert "SortMergeJoin" not in passing
    assert records.todo(rows, done.withColumnRenamed("key", "id"), "id").columns == rows.columns  # one of them has a name that may clash
    monkeypatch.setattr(bloom, "MOST", 0)  # too long for a filter: joined by key
    assert sorted((r.id,) for r in bloom.without(rows.drop("_done"), done, "key").collect()) == want


def slices_of(spark, monkeypatch):
    """Counts of the slices that a query of the test makes."""
    seen = []
    plain = running.sliced

    def watched(*args):
        rows = plain(*args)
        seen.append(rows.groupBy("_slice").count().count())
        return rows

    monkeypatch.setattr(running, "sliced", watched)
    return seen


def test_carry_forward_in_a_group_of_all_rows(spark, monkeypatch):
    seen = slices_of(spark, monkeypatch)
    monkeypatch.setattr(running, "HOT", 1_000)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(4_000).select(F.lit("all").alias("g"), "id", F.when(F.col("id") % 1_500 == 700, F.col("id")).alias("h"))
        rows = rows.union(spark.createDataFrame([(None, 5, None), (None, 6, 60), (None, 7, None), ("z", 1, None)], "g string, id bigint, h bigint")).repartition(7)
        got = {(r.g, r.id): r.h for r in records.carry_forward(rows, "h", ["g"], [F.desc("id")]).collect()}
        want = {("all", i): next((j for j in range(i, 4_000) if j % 1_500 == 700), None) for i in range(4_000)} | {(None, 5): 60, (None, 6): 60, (None, 7): None, ("z", 1): None}
        assert got == want and seen == [4]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_quantiles_of_a_group_of_all_rows(spark, monkeypatch):
    seen = slices_of(spark, monkeypatch)
    monkeypatch.setattr(running, "FEW", 1_000)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        x = np.random.default_rng(3).permutation(3_000)
        rows = spark.createDataFrame([("a", float(v), float(v % 4)) for v in x] + [("b", 1.0, 2.0), ("c", None, 1.0), (None, 4.0, 1.0)], "g string, x double, w double").repartition(5)
        got = {r.g: (r.q30, r.q50) for r in survey.weighted_quantiles(rows, ["g"], "x", "w", [0.3, 0.5]).collect()}
        values, weights = np.arange(3_000.0), np.arange(3_000) % 4.0
        values, weights = values[weights > 0], weights[weights > 0]
        cw, n = np.cumsum(weights), weights.sum()

        def quantile(p):
            o = 1 + (n - 1) * p
            low = max(np.floor(o), 1)
            at = lambda v: values[np.searchsorted(cw, v)]
            return (1 - (o - np.floor(o))) * at(low) + (o - np.floor(o)) * at(min(low + 1, n))

        assert got["a"] == pytest.approx((quantile(0.3), quantile(0.5))) and got["b"] == (1.0, 1.0) and got[None] == (4.0, 4.0) and "c" not in got
        assert seen == [4]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_labels_are_numbered_without_one_task(spark, monkeypatch):
    monkeypatch.setattr(running, "FEW", 0)
    rows = spark.range(3_000).select(F.format_string("%05d", F.col("id")).alias("t"), F.when(F.col("id") % 10 > 0, F.col("id") % 7).alias("x"))
    made = running.numbered(rows, [F.col("x").desc_nulls_last(), F.col("t")], "n")
    want = sorted(((-(i % 7) if i % 10 else 1, f"{i:05d}") for i in range(3_000)))
    assert [r.t for r in made.orderBy("n").collect()] == [t for _, t in want] and {r.n for r in made.collect()} == set(range(1, 3_001))
    windows = [line for line in plan_of(made).splitlines() if "Window" in line]
    assert windows and all("_slice" in line for line in windows)
    monkeypatch.setattr(running, "FEW", 3_000)
    assert made.exceptAll(running.numbered(rows, [F.col("x").desc_nulls_last(), F.col("t")], "n")).count() == 0
    few = survey.order_by_stat(spark.createDataFrame([], rows.schema), "t", "x")
    assert few.count() == 0 and few.columns == ["t", "x", "ord"]


def test_mode_counts_before_it_chooses(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("a", 2), ("b", None), ("b", None), ("c", 3), ("c", None), (None, 5)], "g string, x int")
    got = survey.mode_by(rows, ["g"], "x")
    assert {r.g: r.mode for r in got.collect()} == {"a": 1, "b": None, "c": 3, None: 5}
    assert "mode(" not in plan_of(got)


def test_cells_of_grids_are_shuffled_once_even_with_a_constant_in_their_key(spark):
    """One shuffle of the cells and one of the header rows; rows with the names of their whole table are not moved."""
    from vellum.operators import grid

    cells = spark.range(60).selectExpr("id % 3 AS page", "id div 3 % 5 AS row_idx", "id div 15 AS col_idx", "concat('v', id) AS text").withColumn("table_index", F.lit(0))
    got = grid.grid_to_records(cells, ["page", "table_index"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2, plan
    assert got.count() == 3 * 4 * 4 and got.filter("header = 'v45' and page = 0").count() == 4

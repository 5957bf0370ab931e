"""Nearest neighbours: grids of queries, stored cells, and lookups of hot keys."""

import math
import random

import pytest
from pyspark.sql import functions as F

from docframe.operators import lookup as lk
from docframe.operators import vectors as v

from conftest import plan


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(2)
    rows = []
    for i in range(900):
        centre = [math.cos(i % 9 + k) for k in range(8)]
        rows.append((i, i % 3, [c + rng.gauss(0, 0.1) for c in centre]))
    rows += [(1000, 0, None), (1001, 0, [1.0]), (1002, 0, [0.0] * 8)]
    return spark.createDataFrame(rows, "id int, g int, x array<double>").repartition(4).cache()


@pytest.fixture(scope="module")
def asked(table):
    return table.where("id % 20 = 0 or id > 999").select(F.col("id").alias("q"), F.col("x").alias("qx"))


@pytest.mark.parametrize("similarity", ["cosine", "dot_product", "l2"])
def test_a_grid_of_queries_finds_what_one_block_finds(table, asked, monkeypatch, similarity):
    monkeypatch.setattr(v, "CELL_NUMBERS", 800)
    one = v.knn_batch(table, "x", "id", asked, "q", "qx", 5, similarity)
    grid = v.knn_batch(table, "x", "id", asked.where("q < 1001"), "q", "qx", 5, similarity, block=7)
    rows = {(r["q"], r["rank"]): (r["id"], round(r["_score"], 9)) for r in one.where("q < 1000").collect()}
    assert rows == {(r["q"], r["rank"]): (r["id"], round(r["_score"], 9)) for r in grid.where("q < 1000").collect()}
    single = v.knn(table, "x", table.where("id = 40").first()["x"], 5, "id", similarity).collect()
    assert [r["id"] for r in single] == [rows[40, k][0] for k in range(1, 6)]
    assert v.knn_batch(table, "x", "id", asked.limit(0), "q", "qx", 5).count() == 0


@pytest.mark.parametrize("similarity", ["cosine", "l2"])
def test_cells_are_pruned_and_reach_their_recall(spark, table, asked, tmp_path, monkeypatch, similarity):
    monkeypatch.setattr(v, "CELL_NUMBERS", 400)  # cuts cells into blocks
    path = str(tmp_path / "cells")
    v.write_cells(table, path, "x", v.fit_cells(table, "x", 9, similarity, sample=300), similarity)
    assert spark.read.parquet(f"{path}/rows").count() == 901
    query = table.where("id = 40").first()["x"]
    near = v.knn_cells(spark, path, "x", query, 5, 150, "id", similarity)
    assert "PartitionFilters: [cell" in plan(near)
    batch = v.knn_cells_batch(spark, path, "x", "id", asked, "q", "qx", 5, 150, similarity)
    assert [r["id"] for r in near.collect()] == [
        r["id"] for r in batch.where("q = 40").orderBy("rank").collect()]
    exact = v.knn_batch(table, "x", "id", asked.where("q < 1000"), "q", "qx", 5, similarity)
    hits = exact.join(batch, ["q", "id"], "left_semi").count()
    assert hits >= 0.9 * exact.count()
    everything = v.knn_cells_batch(spark, path, "x", "id", asked.where("q < 1000"), "q", "qx", 5, 10 ** 6, similarity)
    assert everything.join(exact, ["q", "id"], "left_anti").count() == 0


def test_the_first_matches_of_a_hot_key(spark):
    rng = random.Random(1)
    rows = [(i, 0 if i % 3 else rng.randrange(1, 9), rng.randrange(50)) for i in range(3000)]
    other = spark.createDataFrame(rows, "id int, k int, n int").repartition(5)
    df = spark.createDataFrame([(k,) for k in range(12)], "k int")
    out = lk.lookup(df, lk.Lookup("hits", other, "k", "k", ["id", "n"], ("n", "desc"), "id", size=7))
    for r in out.collect():
        mine = sorted(((-n, i) for i, k, n in rows if k == r["k"]))
        assert [(h["id"], h["n"]) for h in r["hits"]] == [(i, -n) for n, i in mine[:7]]
        assert r["hits_total"] == len(mine)

"""Nearest-neighbour search."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import functions as F

from ..operators import clauses as c
from ..operators import ranking as r
from ..operators import vectors as v
from ..operators.paging import numbered
from ..sources.lineage import shared_folder, stored
from ..sources.tables import read
from .ranking import bm25_sql
from .registry import query
from .text import documents

DIMS = 64
# The query vector of the examples: a plain wave, the same in Spark and in SQL.
WAVE = [round(math.sin(0.7 * (i + 1)), 6) for i in range(DIMS)]
WAVE_SQL = f"{WAVE}::DOUBLE[{DIMS}]"
VECTORS = f"(SELECT vec_id, label, embedding::DOUBLE[{DIMS}] AS e FROM embeddings)"
SCORE_SQL = {
    "cosine": f"(1 + array_cosine_similarity(e, {WAVE_SQL})) / 2",
    "dot_product": f"(1 + array_inner_product(e, {WAVE_SQL})) / 2",
    "l2": f"1 / (1 + pow(array_distance(e, {WAVE_SQL}), 2))",
}


def _top_sql(similarity: str, k: int, where: str = "true") -> str:
    return f"""
    SELECT vec_id, label, round(s, 6) AS score, row_number() OVER (ORDER BY s DESC, vec_id) AS rank
    FROM (SELECT vec_id, label, {SCORE_SQL[similarity]} AS s FROM {VECTORS} WHERE {where})
    ORDER BY rank LIMIT {k}"""


def _top(spark, sf, similarity, k, where=None):
    hits = v.knn(read(spark, sf, "embeddings"), "embedding", WAVE, k, "vec_id", similarity, where)
    return numbered(hits, ("_score", "desc"), "vec_id").select(
        "vec_id", "label", F.round("_score", 6).alias("score"), "rank")


@query("knn_cosine", _top_sql("cosine", 20))
def knn_cosine(spark, sf):
    return _top(spark, sf, "cosine", 20)


@query("knn_dot", _top_sql("dot_product", 20))
def knn_dot(spark, sf):
    return _top(spark, sf, "dot_product", 20)


@query("knn_l2", _top_sql("l2", 20))
def knn_l2(spark, sf):
    return _top(spark, sf, "l2", 20)


@query("knn_filtered", _top_sql("cosine", 15, "label IN (3, 7)"))
def knn_filtered(spark, sf):
    return _top(spark, sf, "cosine", 15, c.terms("label", [3, 7]))


def centroids(spark, sf):
    """Mean vector per label, by position, so each partial sum is a few numbers."""
    parts = read(spark, sf, "embeddings").select("label", F.posexplode("embedding"))
    means = parts.groupBy("label", "pos").agg(
        F.avg(F.col("col").cast("double")).alias("x"))
    return means.groupBy("label").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda s: s["x"]).alias("center"))


@query("knn_batch", f"""
    WITH c AS (SELECT label, list(m ORDER BY i)::DOUBLE[{DIMS}] AS q FROM (
        SELECT label, i, avg(x::DOUBLE) AS m FROM (
            SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i
            FROM embeddings) GROUP BY 1, 2) GROUP BY 1),
    s AS (SELECT c.label AS center, vec_id, (1 + array_cosine_similarity(e, q)) / 2 AS s
          FROM c, {VECTORS})
    SELECT center, vec_id, round(s, 6) AS score,
           row_number() OVER (PARTITION BY center ORDER BY s DESC, vec_id) AS rank
    FROM s QUALIFY rank <= 10""")
def knn_batch(spark, sf):
    """Every label's centre as a query: its ten nearest vectors."""
    queries = centroids(spark, sf).withColumnRenamed("label", "center_label")
    best = v.knn_batch(read(spark, sf, "embeddings"), "embedding", "vec_id",
                       queries, "center_label", "center", 10)
    return best.select(F.col("center_label").alias("center"), "vec_id",
                       F.round("_score", 6).alias("score"),
                       F.col("rank").cast("long").alias("rank"))


@query("knn_lsh", "SELECT 10 AS wanted, true AS found_most")
def knn_lsh(spark, sf):
    """Ten nearest by 200 candidates, held against the exact ten: at least eight are found. The
    signatures are made here for all vectors, which costs more than the exact search does; the form
    saves work only where they are stored with the table."""
    vectors = read(spark, sf, "embeddings")
    signed = v.signature(vectors, "embedding", DIMS).select("vec_id", "signature")
    near = v.knn_candidates(signed, vectors, "embedding", WAVE, 10, 200, "vec_id").select("vec_id")
    exact = v.knn(vectors, "embedding", WAVE, 10, "vec_id").select("vec_id")
    return exact.join(near.withColumn("hit", F.lit(1)), "vec_id", "left").agg(
        F.count(F.lit(1)).alias("wanted"), (F.count("hit") >= 8).alias("found_most"))


@query("knn_cells", "SELECT 50 AS queries, 10 AS k, true AS recall_reached")
def knn_cells(spark, sf):
    """Fifty of the vectors as queries (least hashes of their ids): ten nearest from the nearest cells, at least
    nine in ten of those that the exact search finds."""
    vectors = read(spark, sf, "embeddings")
    path = f"{shared_folder(spark)}/cells-{uuid.uuid4().hex}"
    v.write_cells(vectors, path, "embedding", v.fit_cells(vectors, "embedding", 24))
    asked = stored(vectors.select(F.col("vec_id").alias("query"), F.col("embedding").alias("x")).orderBy(
        F.md5(F.col("query").cast("string")), "query").limit(50))
    budget = int(vectors.count() * 0.65)  # these vectors have next to no clusters
    near = v.knn_cells_batch(spark, path, "embedding", "vec_id", asked, "query", "x", 10, budget)
    exact = v.knn_batch(vectors, "embedding", "vec_id", asked, "query", "x", 10)
    both = exact.join(near.select("query", "vec_id", F.lit(1).alias("hit")), ["query", "vec_id"], "left")
    return both.agg(
        F.count_distinct("query").alias("queries"), F.max("rank").cast("int").alias("k"),
        (F.count("hit") >= 0.9 * F.count(F.lit(1))).alias("recall_reached"))


@query("hybrid_search", f"""
    WITH {bm25_sql("documents", "doc_id", "text", ["erth", "the"], "b")},
    h AS (SELECT doc_id, sum(s) AS s FROM b GROUP BY 1),
    n AS (SELECT vec_id, {SCORE_SQL["cosine"]} AS s FROM {VECTORS} ORDER BY s DESC, vec_id
          LIMIT 100)
    SELECT h.doc_id, round(h.s + coalesce(2.0 * n.s, 0), 6) AS score,
           n.s IS NOT NULL AS near
    FROM h LEFT JOIN n ON h.doc_id = n.vec_id""")
def hybrid_search(spark, sf):
    text = r.search(documents(spark, sf), c.match("text", "erth the"), scored=True)
    near = v.knn(read(spark, sf, "embeddings"), "embedding", WAVE, 100, "vec_id")
    out = v.hybrid(text, "doc_id", near, "vec_id", boost=2.0)
    return out.select("doc_id", F.round("_score", 6).alias("score"), "near")

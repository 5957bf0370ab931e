"""BM25-ranked search, boosts and multi-field scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clauses as c
from ..operators import ranking as r
from ..operators.paging import numbered
from ..sources.tables import read
from .registry import query
from .text import documents, toks


def bm25_sql(table: str, key: str, field: str, words: list[str], name: str) -> str:
    """CTEs giving (key, s) per row and query word of one field, under ``name``."""
    listed = ", ".join(f"'{w}'" for w in words)
    return f"""
    {name}_t AS (SELECT {key}, {toks(field)} AS t FROM {table}),
    {name}_n AS (SELECT count(*) FILTER (len(t) > 0) AS n,
                        sum(len(t)) / count(*) FILTER (len(t) > 0) AS mean FROM {name}_t),
    {name}_tf AS (SELECT {key}, w, len(t) AS dl, count(*) AS tf
                  FROM (SELECT {key}, t, unnest(t) AS w FROM {name}_t)
                  WHERE w IN ({listed}) GROUP BY {key}, w, len(t)),
    {name}_df AS (SELECT w, count(*) AS df FROM {name}_tf GROUP BY w),
    {name} AS (SELECT {key}, w, ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2
                      / (tf + 1.2 * (0.25 + 0.75 * dl / mean)) AS s
               FROM {name}_tf JOIN {name}_df USING (w) CROSS JOIN {name}_n)"""


def score6():
    return F.round("_score", 6).alias("score")

RING = bm25_sql("documents", "doc_id", "text", ["erth", "thtion", "with"], "b")


@query("score_bm25", f"""
    WITH {RING}
    SELECT doc_id, round(sum(s), 6) AS score FROM b GROUP BY 1""")
def score_bm25(spark, sf):
    hits = r.search(documents(spark, sf), c.match("text", "erth thtion with"), scored=True)
    return hits.select("doc_id", score6())


@query("max_score", f"""
    WITH {RING}
    SELECT round(max(s), 6) AS max_score FROM (SELECT sum(s) AS s FROM b GROUP BY doc_id)""")
def max_score(spark, sf):
    hits = r.search(documents(spark, sf), c.match("text", "erth thtion with"), scored=True)
    return r.max_score(hits).select(F.round("max_score", 6).alias("max_score"))


@query("topk_score", f"""
    WITH {RING}, h AS (SELECT doc_id, sum(s) AS s FROM b GROUP BY 1)
    SELECT doc_id, round(s, 6) AS score,
           row_number() OVER (ORDER BY round(s, 9) DESC, doc_id) AS rank
    FROM h ORDER BY rank LIMIT 20""")
def topk_score(spark, sf):
    hits = r.search(documents(spark, sf), c.match("text", "erth thtion with"), scored=True)
    # near-equal sums are ranked alike whatever order they were added in
    hits = hits.withColumn("_score", F.round("_score", 9))
    top = r.top_hits(hits.select("doc_id", "_score"), 20, "doc_id")
    return numbered(top, ("_score", "desc"), "doc_id").select("doc_id", score6(), "rank")


@query("score_boost", """
    SELECT p_partkey,
           (CASE WHEN p_brand = 'Brand#2' THEN 2.5 ELSE 0 END
            + CASE WHEN p_name LIKE 'cold%' THEN 0.5 ELSE 0 END
            + CASE WHEN p_name LIKE '%r_ng' THEN 3.0 ELSE 0 END
            + CASE WHEN p_size IS NOT NULL THEN 1.5 ELSE 0 END) * 2::DOUBLE AS score
    FROM part
    WHERE p_brand = 'Brand#2' OR p_name LIKE 'cold%' OR p_name LIKE '%r_ng'""")
def score_boost(spark, sf):
    wanted = c.bool_(boost=2, must=[c.exists("p_size", boost=1.5)], minimum_should_match=1,
                     should=[c.term("p_brand", "Brand#2", boost=2.5),
                             c.prefix("p_name", "cold", boost=0.5),
                             c.wildcard("p_name", "*r?ng", boost=3)])
    return r.search(read(spark, sf, "part"), wanted, scored=True).select("p_partkey", score6())


@query("score_bool", f"""
    WITH {bm25_sql("documents", "doc_id", "text", ["the", "erth"], "b")}
    SELECT d.doc_id, round(1.5 * max(CASE WHEN w = 'the' THEN s END)
        + coalesce(max(CASE WHEN w = 'erth' THEN s END), 0)
        + CASE WHEN any_value(source) = 'src3' THEN 4.0 ELSE 0 END, 6) AS score
    FROM documents d JOIN b ON d.doc_id = b.doc_id
    WHERE lang = 'en' AND n_chars < 4000 GROUP BY 1 HAVING bool_or(w = 'the')""")
def score_bool(spark, sf):
    wanted = c.bool_(
        must=[c.match("text", "the", boost=1.5)], filter=[c.term("lang", "en")],
        should=[c.match("text", "erth"), c.term("source", "src3", boost=4)],
        must_not=[c.range_("n_chars", gte=4000)],
    )
    return r.search(documents(spark, sf), wanted, scored=True).select("doc_id", score6())


NAMES = bm25_sql("part", "p_partkey", "p_name", ["small", "ring"], "a")
TYPES = bm25_sql("part", "p_partkey", "p_type", ["small", "ring"], "b")


@query("mm_best_fields", f"""
    WITH {NAMES}, {TYPES},
    f AS (SELECT p_partkey, 'a' AS f, sum(s) AS s FROM a GROUP BY 1
          UNION ALL SELECT p_partkey, 'b', sum(s) FROM b GROUP BY 1)
    SELECT p_partkey, round(max(s), 6) AS score FROM f GROUP BY 1""")
def mm_best_fields(spark, sf):
    wanted = c.multi_match("small ring", ["p_name", "p_type"], "best_fields")
    return r.search(read(spark, sf, "part"), wanted, scored=True).select("p_partkey", score6())


@query("mm_most_fields", f"""
    WITH {NAMES}, {TYPES}, f AS (SELECT * FROM a UNION ALL SELECT * FROM b)
    SELECT p_partkey, round(sum(s), 6) AS score FROM f GROUP BY 1""")
def mm_most_fields(spark, sf):
    wanted = c.multi_match("small ring", ["p_name", "p_type"], "most_fields")
    return r.search(read(spark, sf, "part"), wanted, scored=True).select("p_partkey", score6())


@query("mm_cross_fields", f"""
    WITH {NAMES}, {TYPES},
    f AS (SELECT p_partkey, w, max(s) AS s
          FROM (SELECT * FROM a UNION ALL SELECT * FROM b) GROUP BY 1, 2)
    SELECT p_partkey, round(sum(s), 6) AS score FROM f GROUP BY 1 HAVING count(*) = 2""")
def mm_cross_fields(spark, sf):
    wanted = c.multi_match("small ring", ["p_name", "p_type"], "cross_fields")
    return r.search(read(spark, sf, "part"), wanted, scored=True).select("p_partkey", score6())


@query("batch_search", f"""
    WITH d AS (SELECT doc_id, {toks('text')} AS t FROM documents),
    n AS (SELECT count(*) FILTER (len(t) > 0) AS n,
                 sum(len(t)) / count(*) FILTER (len(t) > 0) AS mean FROM d),
    q AS (SELECT DISTINCT item_id, unnest({toks('text')}) AS w FROM benchmark),
    tf AS (SELECT doc_id, w, len(t) AS dl, count(*) AS tf
           FROM (SELECT doc_id, t, unnest(t) AS w FROM d)
           WHERE w IN (SELECT w FROM q) GROUP BY doc_id, w, len(t)),
    df AS (SELECT w, count(*) AS df FROM tf GROUP BY w),
    s AS (SELECT item_id, doc_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2
                 / (tf + 1.2 * (0.25 + 0.75 * dl / mean))), 9) AS s
          FROM q JOIN tf USING (w) JOIN df USING (w) CROSS JOIN n GROUP BY 1, 2)
    SELECT item_id, doc_id, round(s, 6) AS score,
           row_number() OVER (PARTITION BY item_id ORDER BY s DESC, doc_id) AS rank
    FROM s QUALIFY rank <= 5""")
def batch_search(spark, sf):
    """Every benchmark passage as a query against all documents: its five best hits."""
    best = r.batch_search(
        documents(spark, sf), "text", "doc_id", read(spark, sf, "benchmark"), "item_id", "text", 5)
    return best.select("item_id", "doc_id", score6(), F.col("rank").cast("long").alias("rank"))

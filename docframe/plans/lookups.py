"""Fetches by id, lookups as lists, refreshes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import lookup as lk
from ..sources.tables import read
from .registry import query


@query("get_by_ids", """
    SELECT DISTINCT l.doc_id, d.lang, d.n_chars, d.doc_id IS NOT NULL AS found
    FROM (SELECT DISTINCT vec_id AS doc_id FROM embeddings) l LEFT JOIN documents d USING (doc_id)
    """)
def get_by_ids(spark, sf):
    ids = read(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"))
    return lk.get_by_ids(ids, read(spark, sf, "documents").select("doc_id", "lang", "n_chars"),
                         "doc_id")


@query("get_missing", """
    SELECT DISTINCT o_custkey * 2 AS c_custkey FROM orders
    WHERE o_custkey * 2 NOT IN (SELECT c_custkey FROM customer)""")
def get_missing(spark, sf):
    ids = read(spark, sf, "orders").select((F.col("o_custkey") * 2).alias("c_custkey"))
    return lk.get_missing(ids, read(spark, sf, "customer"), "c_custkey")


def _orders_of(spark, sf, size):
    return lk.Lookup("orders", read(spark, sf, "orders"), "c_custkey", "o_custkey",
                     ["o_orderkey", "o_totalprice"], [("o_totalprice", "desc")], "o_orderkey",
                     size)


def _keys(name: str, field: str):
    return F.array_join(F.transform(name, lambda x: x[field].cast("string")), ",")


FIRST_ORDERS = """SELECT o_custkey, string_agg(o_orderkey, ',' ORDER BY rn) AS keys, any_value(n) AS n
    FROM (SELECT o_custkey, o_orderkey,
                 row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey)
                     AS rn,
                 count(*) OVER (PARTITION BY o_custkey) AS n FROM orders)
    WHERE rn <= {size} GROUP BY 1"""


@query("lazy_lookup", f"""
    SELECT c_custkey, coalesce(keys, '') AS orders, coalesce(n, 0) AS orders_total
    FROM customer LEFT JOIN ({FIRST_ORDERS.format(size=5)}) ON c_custkey = o_custkey""")
def lazy_lookup(spark, sf):
    out = lk.lookup(read(spark, sf, "customer"), _orders_of(spark, sf, 5))
    return out.select("c_custkey", _keys("orders", "o_orderkey").alias("orders"), "orders_total")


@query("lazy_nested", """
    WITH s AS (SELECT n_nationkey, string_agg(s_suppkey, ',' ORDER BY s_suppkey) AS keys FROM (
        SELECT s_nationkey AS n_nationkey, s_suppkey,
               row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS rn
        FROM supplier) WHERE rn <= 3 GROUP BY 1)
    SELECT c_custkey, c_nationkey AS nation, coalesce(keys, '') AS suppliers
    FROM customer LEFT JOIN s ON c_nationkey = n_nationkey""")
def lazy_nested(spark, sf):
    """A lookup declared on an object inside the row; its result lands in that object."""
    rows = read(spark, sf, "customer").select(
        "c_custkey", F.struct(F.col("c_nationkey").alias("nation")).alias("home"))
    out = lk.lookup(rows, lk.Lookup("suppliers", read(spark, sf, "supplier"), "home.nation",
                                    "s_nationkey", ["s_suppkey"], "s_suppkey", "s_suppkey", 3))
    return out.select("c_custkey", F.col("home.nation").alias("nation"),
                      _keys("home.suppliers", "s_suppkey").alias("suppliers"))


@query("lazy_depth2", f"""
    WITH o AS ({FIRST_ORDERS.format(size=2)}),
    c AS (SELECT c_nationkey, c_custkey, coalesce(keys, '') AS keys,
                 row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey)
                     AS rn
          FROM customer LEFT JOIN o ON c_custkey = o_custkey)
    SELECT n_nationkey, string_agg(c_custkey || '[' || keys || ']', ';' ORDER BY rn) AS customers,
           true AS deeper_is_null
    FROM nation JOIN c ON c_nationkey = n_nationkey WHERE rn <= 4 GROUP BY 1""")
def lazy_depth2(spark, sf):
    """Nations with their customers with their orders; at depth 1 the orders are null."""
    steps = [
        lk.Lookup("customers", read(spark, sf, "customer"), "n_nationkey", "c_nationkey",
                  ["c_custkey"], [("c_acctbal", "desc")], "c_custkey", 4),
        _orders_of(spark, sf, 2),
    ]
    nations = read(spark, sf, "nation")
    deep = lk.lookup_chain(nations, steps, depth=2).select("n_nationkey", F.array_join(
        F.transform("customers", lambda c: F.concat(
            c["c_custkey"].cast("string"), F.lit("["), F.array_join(F.transform(
                c["orders"], lambda o: o["o_orderkey"].cast("string")), ","), F.lit("]"))),
        ";").alias("customers"))
    flat = lk.lookup_chain(nations, steps, depth=1).select("n_nationkey", F.forall(
        "customers", lambda c: c["orders"].isNull()).alias("deeper_is_null"))
    return deep.where("customers <> ''").join(flat, "n_nationkey")


@query("reload_rows", """
    SELECT o_orderkey AS _id, coalesce(c_acctbal, o_totalprice) AS balance,
           CASE WHEN c_custkey IS NULL THEN o_orderpriority ELSE c_mktsegment END AS label,
           c_custkey IS NOT NULL AS fresh
    FROM orders LEFT JOIN customer ON o_orderkey = c_custkey""")
def reload_rows(spark, sf):
    """Stale copies under order numbers; customers hold the current state of some of them."""
    stale = read(spark, sf, "orders").select(
        F.col("o_orderkey").alias("_id"), F.col("o_totalprice").alias("balance"),
        F.col("o_orderpriority").alias("label"))
    current = read(spark, sf, "customer").select(
        F.col("c_custkey").alias("_id"), F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("label"))
    return lk.reload(stale, current).withColumnRenamed("_fresh", "fresh")

"""Sorting, pages, totals, projections and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clauses as c
from ..operators import paging as p
from ..operators.ranking import search
from ..sources.tables import read
from ..spec import Field, Spec
from .registry import query


@query("sort_single", """
    SELECT o_orderkey, o_totalprice,
           row_number() OVER (ORDER BY o_totalprice NULLS LAST, o_orderkey) AS rank
    FROM orders ORDER BY rank LIMIT 500""")
def sort_single(spark, sf):
    top = p.page(read(spark, sf, "orders"), "o_totalprice", "o_orderkey", size=500)
    return p.numbered(top, "o_totalprice", "o_orderkey").select(
        "o_orderkey", "o_totalprice", "rank")


MULTI = [("o_orderstatus", "desc"), "o_orderpriority", ("amount", "desc")]


@query("sort_multi", """
    WITH r AS (SELECT o_orderkey, o_orderstatus, o_orderpriority,
                      CASE WHEN o_totalprice > 100000 THEN o_totalprice END AS amount FROM orders)
    SELECT *, row_number() OVER (ORDER BY o_orderstatus DESC NULLS LAST,
        o_orderpriority NULLS LAST, amount DESC NULLS LAST, o_orderkey) AS rank
    FROM r ORDER BY rank LIMIT 1000""")
def sort_multi(spark, sf):
    rows = read(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", "o_orderpriority",
        F.when(F.col("o_totalprice") > 100000, F.col("o_totalprice")).alias("amount"))
    return p.numbered(p.page(rows, MULTI, "o_orderkey", size=1000), MULTI, "o_orderkey")


SUPPLIER = Spec("supplier", (
    Field("s_suppkey", "long"), Field("s_name"), Field("s_acctbal", "double")),
    id_field="s_suppkey", default_sort=("s_acctbal", "desc"))


@query("sort_default", """
    SELECT 'default' AS kind, s_suppkey,
           row_number() OVER (ORDER BY s_acctbal DESC, s_suppkey) AS rank FROM supplier
    UNION ALL
    SELECT 'explicit', s_suppkey, row_number() OVER (ORDER BY s_name, s_suppkey)
    FROM supplier""")
def sort_default(spark, sf):
    """The spec's own sort holds unless the caller names one."""
    suppliers = read(spark, sf, "supplier")
    out = []
    for kind, chosen in (("default", None), ("explicit", "s_name")):
        ranks = p.ranked(suppliers, SUPPLIER.sort_or(chosen), "s_suppkey")
        out.append(ranks.select(F.lit(kind).alias("kind"), "s_suppkey", "rank"))
    return out[0].unionByName(out[1])


@query("paginate_p1", """
    SELECT event_id, ts FROM events ORDER BY ts DESC, event_id LIMIT 25""")
def paginate_p1(spark, sf):
    return p.page(read(spark, sf, "events"), ("ts", "desc"), "event_id", size=25
                  ).select("event_id", "ts")


@query("paginate_p2", """
    SELECT event_id, ts FROM events ORDER BY ts DESC, event_id LIMIT 25 OFFSET 25""")
def paginate_p2(spark, sf):
    return p.page(read(spark, sf, "events"), ("ts", "desc"), "event_id", 2, 25
                  ).select("event_id", "ts")


@query("paginate_total", """
    SELECT o_orderkey, (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS total
    FROM orders WHERE o_orderstatus = 'F' ORDER BY o_orderkey LIMIT 50000""")
def paginate_total(spark, sf):
    hits = search(read(spark, sf, "orders"), c.term("o_orderstatus", "F"))
    return p.page_with_total(hits, "o_orderkey", "o_orderkey", size=50_000).select(
        "o_orderkey", "total")


@query("total_hits", "SELECT count(*) AS total FROM orders WHERE o_orderstatus = 'F'")
def total_hits(spark, sf):
    return p.total(search(read(spark, sf, "orders"), c.term("o_orderstatus", "F")))


@query("sort_page", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem
    WHERE l_returnflag = 'R'
    ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey LIMIT 40 OFFSET 80""")
def sort_page(spark, sf):
    hits = search(read(spark, sf, "lineitem"), c.term("l_returnflag", "R"))
    return p.page(hits, [("l_extendedprice", "desc"), "l_orderkey", "l_linenumber"],
                  "l_partkey", 3, 40).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")


@query("search_one", """
    SELECT p_partkey, p_name FROM part WHERE p_size = 11 AND p_brand = 'Brand#2'
    ORDER BY p_retailprice, p_partkey LIMIT 1""")
def search_one(spark, sf):
    hits = search(read(spark, sf, "part"), c.by_fields({"p_size": 11, "p_brand": "Brand#2"}))
    return p.first(hits, "p_retailprice", "p_partkey").select("p_partkey", "p_name")


@query("paginate_keyset", """
    SELECT event_id, value FROM events
    WHERE value < 60.0 OR (value = 60.0 AND event_id > 500)
    ORDER BY value DESC, event_id LIMIT 100""")
def paginate_keyset(spark, sf):
    return p.page_after(read(spark, sf, "events"), ("value", "desc"), "event_id",
                        (60.0, 500), size=100).select("event_id", "value")


def _buyers(spark, sf, clause):
    return search(read(spark, sf, "orders"), clause)


URGENT = "SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'"
LARGE = "SELECT o_custkey FROM orders WHERE o_totalprice >= 400000"


@query("set_union", f"{URGENT} UNION {LARGE}")
def set_union(spark, sf):
    return p.union_hits([
        _buyers(spark, sf, c.term("o_orderpriority", "1-URGENT")),
        _buyers(spark, sf, c.range_("o_totalprice", gte=400000))], "o_custkey")


@query("set_intersect", f"{URGENT} INTERSECT {LARGE}")
def set_intersect(spark, sf):
    return p.intersect_hits(
        _buyers(spark, sf, c.term("o_orderpriority", "1-URGENT")),
        _buyers(spark, sf, c.range_("o_totalprice", gte=400000)), "o_custkey")


@query("set_except", f"{URGENT} EXCEPT {LARGE}")
def set_except(spark, sf):
    return p.except_hits(
        _buyers(spark, sf, c.term("o_orderpriority", "1-URGENT")),
        _buyers(spark, sf, c.range_("o_totalprice", gte=400000)), "o_custkey")

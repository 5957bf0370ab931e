"""Exact-value, geo, list and boolean clauses."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clauses as c
from ..operators import facets
from ..operators.ranking import search
from ..sources.tables import read
from ..spec import Field, Spec
from .registry import query

SHIPPED = "TIMESTAMP '1996-01-01'"


@query("flagship", """
    SELECT l_returnflag AS key, count(*) AS doc_count, round(avg(l_quantity), 6) AS avg_quantity,
           round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue
    FROM lineitem
    WHERE l_quantity >= 5 AND l_discount < 0.08 AND NOT (l_linestatus = 'O')
    GROUP BY 1""")
def flagship(spark, sf):
    wanted = c.bool_(
        must=[c.range_("l_quantity", gte=5), c.range_("l_discount", lt=0.08)],
        must_not=[c.term("l_linestatus", "O")],
    )
    return facets.terms(
        search(read(spark, sf, "lineitem"), wanted), "l_returnflag", size=10, metrics=[
            F.round(F.avg("l_quantity"), 6).alias("avg_quantity"),
            F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2)
            .alias("revenue"),
        ])


def _found(spark, sf, table, key, clause):
    return search(read(spark, sf, table), clause).select(*key)


ITEM = ("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query("f_range", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
    WHERE l_quantity > 10 AND l_quantity <= 20 AND l_shipdate >= TIMESTAMP '1996-01-01'""")
def f_range(spark, sf):
    return _found(spark, sf, "lineitem", ITEM, c.bool_(must=[
        c.range_("l_quantity", gt=10, lte=20),
        c.range_("l_shipdate", gte=c.date_math("1996-01-01||", "now")),
    ]))


@query("f_date_math", """
    SELECT event_id, ts FROM events
    WHERE ts >= TIMESTAMP '2024-01-20 12:00:00' - INTERVAL 3630 SECOND - INTERVAL 7 DAY
      AND ts < date_trunc('day', TIMESTAMP '2024-01-20 12:00:00')""")
def f_date_math(spark, sf):
    return _found(spark, sf, "events", ("event_id", "ts"),
                  c.range_("ts", gte="now-3630s-7d", lt="now/d", now="2024-01-20 12:00:00"))


ORDERS = c.Declared(Spec("orders", (Field("o_orderkey", "long"), Field("o_orderstatus"))))
PARTS = c.Declared(Spec("part", (
    Field("p_partkey", "long"), Field("p_name", "text"), Field("p_size", "integer"), Field("p_brand"),
    Field("p_type"))))
LINKS = c.Declared(Spec("links", (Field("page_id", "long"), Field("parts", many=True))))


@query("f_term", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'P'")
def f_term(spark, sf):
    return _found(spark, sf, "orders", ("o_orderkey", "o_orderstatus"),
                  ORDERS.term("o_orderstatus", "P"))


@query("f_terms", """
    SELECT o_orderkey, o_orderpriority FROM orders
    WHERE o_orderpriority IN ('1-URGENT', '5-LOW')
      AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
      AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""")
def f_terms(spark, sf):
    hits = search(read(spark, sf, "orders"), c.terms("o_orderpriority", ["1-URGENT", "5-LOW"]))
    customers = read(spark, sf, "customer")
    hits = c.terms_from(hits, "o_custkey",
                        customers.where(c.term("c_mktsegment", "BUILDING").pred), "c_custkey")
    hits = c.not_terms_from(hits, "o_custkey",
                            customers.where(c.range_("c_acctbal", lt=0).pred), "c_custkey")
    return hits.select("o_orderkey", "o_orderpriority")


@query("f_by_fields", """
    SELECT p_partkey, p_name FROM part
    WHERE p_size = 11 AND p_brand = 'Brand#2'
       OR (regexp_matches(lower(p_name), '(^|[^\\p{L}\\p{N}])ring($|[^\\p{L}\\p{N}])')
           AND regexp_matches(lower(p_name), '(^|[^\\p{L}\\p{N}])small($|[^\\p{L}\\p{N}])')
           AND p_type = 'ECONOMY')""")
def f_by_fields(spark, sf):
    either = c.bool_(should=[
        PARTS.by_fields({"p_size": 11, "p_brand": "Brand#2"}),
        PARTS.by_fields({"p_name": "ring small", "p_type": "ECONOMY"}),
    ])
    return _found(spark, sf, "part", ("p_partkey", "p_name"), either)


@query("f_exists", """
    SELECT event_id FROM events
    WHERE nullif(event_type, 'click') IS NOT NULL
      AND len(CASE WHEN value > 20 THEN [value] ELSE [] END) > 0""")
def f_exists(spark, sf):
    rows = read(spark, sf, "events").select(
        "event_id", F.nullif("event_type", F.lit("click")).alias("kind"),
        F.filter(F.array("value"), lambda v: v > 20).alias("values"),
    )
    return search(rows, c.bool_(must=[c.exists("kind"), c.exists("values", is_list=True)])
                  ).select("event_id")


@query("f_wildcard", """
    SELECT p_partkey, p_name, p_brand FROM part
    WHERE p_name LIKE 's%r_ng' OR lower(p_brand) LIKE 'brand#1_'""")
def f_wildcard(spark, sf):
    either = c.bool_(should=[
        c.wildcard("p_name", "s*r?ng"),
        c.wildcard("p_brand", "BRAND#1?", case_insensitive=True),
    ])
    return _found(spark, sf, "part", ("p_partkey", "p_name", "p_brand"), either)


@query("f_prefix", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'cold %'")
def f_prefix(spark, sf):
    return _found(spark, sf, "part", ("p_partkey", "p_name"), c.prefix("p_name", "cold "))


POINTS = """SELECT c_custkey, (c_custkey * 37 % 18000) / 100.0 - 90 AS lat,
                   (c_custkey * 73 % 36000) / 100.0 - 180 AS lon FROM customer"""
HAVERSINE = """2 * 6371.0088 * asin(least(1.0, sqrt(
    pow(sin(radians(lat - {lat}) / 2), 2)
    + cos(radians({lat})) * cos(radians(lat)) * pow(sin(radians(lon - {lon}) / 2), 2))))"""


def points(spark, sf):
    key = F.col("c_custkey")
    return read(spark, sf, "customer").select(
        "c_custkey",
        (F.pmod(key * 37, F.lit(18000)) / 100.0 - 90).alias("lat"),
        (F.pmod(key * 73, F.lit(36000)) / 100.0 - 180).alias("lon"),
    )


@query("f_geo_distance", f"""
    SELECT c_custkey FROM ({POINTS})
    WHERE {HAVERSINE.format(lat=-60.0, lon=-100.0)} <= 2500
       OR {HAVERSINE.format(lat=10.0, lon=175.0)} <= 3000 * 1.609344""")
def f_geo_distance(spark, sf):
    near = c.bool_(should=[
        c.geo_distance("lat", "lon", {"lat": -60.0, "lon": -100.0}, "2500km"),
        c.geo_distance("lat", "lon", "10.0,175.0", "3000mi"),
    ])
    return search(points(spark, sf), near).select("c_custkey")


@query("geo_distance_km", f"""
    SELECT c_custkey, round({HAVERSINE.format(lat=48.85, lon=2.35)}, 6) AS km FROM ({POINTS})""")
def geo_distance_km(spark, sf):
    from ..functions.geo import haversine_km

    return points(spark, sf).select(
        "c_custkey", F.round(haversine_km(F.col("lat"), F.col("lon"), 48.85, 2.35), 6).alias("km"))


@query("f_match_all", "SELECT n_nationkey, n_name FROM nation")
def f_match_all(spark, sf):
    return _found(spark, sf, "nation", ("n_nationkey", "n_name"), c.match_all())


@query("f_match_none", "SELECT n_nationkey, n_name FROM nation WHERE false")
def f_match_none(spark, sf):
    return _found(spark, sf, "nation", ("n_nationkey", "n_name"), c.match_none())


@query("b_must", """
    SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND o_totalprice >= 250000""")
def b_must(spark, sf):
    return _found(spark, sf, "orders", ["o_orderkey"], c.bool_(must=[
        c.term("o_orderstatus", "F"), c.range_("o_totalprice", gte=250000)]))


@query("b_filter", """
    SELECT o_orderkey, 1.0::DOUBLE AS _score FROM orders
    WHERE o_orderstatus = 'F' AND o_totalprice >= 250000""")
def b_filter(spark, sf):
    wanted = c.bool_(must=[c.term("o_orderstatus", "F")],
                     filter=[c.range_("o_totalprice", gte=250000)])
    return search(read(spark, sf, "orders"), wanted, scored=True).select("o_orderkey", "_score")


@query("b_should", """
    SELECT o_orderkey FROM orders
    WHERE o_orderpriority = '1-URGENT' OR o_totalprice < 20000 OR o_custkey = 7""")
def b_should(spark, sf):
    return _found(spark, sf, "orders", ["o_orderkey"], c.bool_(should=[
        c.term("o_orderpriority", "1-URGENT"), c.range_("o_totalprice", lt=20000),
        c.term("o_custkey", 7)]))


@query("b_must_not", """
    SELECT event_id FROM events
    WHERE coalesce(nullif(event_type, 'view') <> 'click', true)
      AND coalesce(NOT (CASE WHEN value > 1 THEN value END < 30), true)""")
def b_must_not(spark, sf):
    rows = read(spark, sf, "events").select(
        "event_id", F.nullif("event_type", F.lit("view")).alias("kind"),
        F.when(F.col("value") > 1, F.col("value")).alias("amount"))
    return search(rows, c.bool_(must_not=[
        c.term("kind", "click"), c.range_("amount", lt=30)])).select("event_id")


@query("b_min_should", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
    WHERE (l_returnflag = 'R')::int + (l_linestatus = 'O')::int + (l_quantity > 25)::int
          + (l_discount >= 0.05)::int >= 3
      AND (l_returnflag = 'R')::int + (l_linestatus = 'O')::int + (l_quantity > 25)::int
          + (l_tax = 0.0)::int >= 2""")
def b_min_should(spark, sf):
    shared = [c.term("l_returnflag", "R"), c.term("l_linestatus", "O"),
              c.range_("l_quantity", gt=25)]
    return _found(spark, sf, "lineitem", ITEM, c.bool_(filter=[
        c.bool_(should=[*shared, c.range_("l_discount", gte=0.05)], minimum_should_match="-1"),
        c.bool_(should=[*shared, c.term("l_tax", 0.0)], minimum_should_match="50%"),
    ]))


@query("b_nested", """
    SELECT o_orderkey FROM orders
    WHERE (o_orderstatus = 'O' OR (o_totalprice >= 400000 AND o_orderpriority LIKE '1-%'))
      AND NOT (o_custkey > 100 AND NOT (o_orderpriority = '5-LOW'))""")
def b_nested(spark, sf):
    return _found(spark, sf, "orders", ["o_orderkey"], c.bool_(
        must=[c.bool_(should=[
            c.term("o_orderstatus", "O"),
            c.bool_(must=[c.range_("o_totalprice", gte=400000), c.prefix("o_orderpriority", "1-")]),
        ])],
        must_not=[c.bool_(must=[c.range_("o_custkey", gt=100)],
                          must_not=[c.term("o_orderpriority", "5-LOW")])],
    ))


@query("f_array_any", r"""
    SELECT page_id FROM (
        SELECT page_id, regexp_split_to_array(url, '[/?&=.#]+') AS parts FROM pages)
    WHERE list_contains(parts, 'ref') AND NOT list_contains(parts, 'm')
       OR len([p FOR p IN parts IF starts_with(p, 'casino')]) > 0""")
def f_array_any(spark, sf):
    rows = read(spark, sf, "pages").select(
        "page_id", F.split("url", "[/?&=.#]+").alias("parts"))
    return search(rows, c.bool_(should=[
        c.bool_(must=[LINKS.match("parts", "ref")], must_not=[LINKS.term("parts", "m")]),
        LINKS.prefix("parts", "casino"),
    ])).select("page_id")


@query("f_nested_same_element", r"""
    SELECT doc_id FROM documents
    WHERE len([x FOR x IN string_split(text, chr(10))
               IF length(x) >= 150 AND starts_with(x, 'The')]) > 0""")
def f_nested_same_element(spark, sf):
    """Some line of the document is long and begins with "The": both on the same line."""
    lines = F.transform(F.split("text", "\n"), lambda x: F.struct(
        F.length(x).alias("size"), x.alias("line")))
    rows = read(spark, sf, "documents").select("doc_id", lines.alias("lines"))
    return search(rows, c.any_element("lines", lambda x: c.bool_(must=[
        c.range_(x["size"], gte=150), c.prefix(x["line"], "The")]))).select("doc_id")

"""Typed documents: scans, checks, encoding, projections."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import dates
from ..operators import paging as p
from ..operators import clauses as c
from ..operators.ranking import search
from ..sources import documents as d
from ..sources import ingest, tables
from ..sources.lineage import shared_folder
from ..sources.tables import read
from ..spec import Field, Spec
from .registry import query

CUSTOMER = Spec("customer", (
    Field("c_custkey", "long"), Field("c_name", "text"), Field("c_nationkey", "integer"),
    Field("c_acctbal", "double", None), Field("c_mktsegment", "keyword", None),
), id_field="c_custkey", default_sort="c_name")

EVENT = Spec("event", (
    Field("event_id", "long"),
    Field("ts", "datetime"),
    Field("user_id", "unsigned_long", gt=10),
    Field("kind", "keyword", "other", alias="event_type", max_length=6,
          allowed=("click", "view", "error", "signup")),
    Field("value", "double", ge=0.5, lt=250, allow_inf_nan=False),
    Field("props", "keyword", None, pattern=r'^\{"k": [0-9]+\}$'),
), id_field="event_id")


@query("scan_all", "SELECT * FROM customer")
def scan_all(spark, sf):
    return read(spark, sf, "customer")


@query("scan_other_table", """
    SELECT s_suppkey AS c_custkey, s_name AS c_name, s_nationkey AS c_nationkey,
           s_acctbal AS c_acctbal, NULL::VARCHAR AS c_mktsegment FROM supplier""")
def scan_other_table(spark, sf):
    """The customer spec read over another table of the same shape."""
    other = read(spark, sf, "supplier").withColumnsRenamed({
        "s_suppkey": "c_custkey", "s_name": "c_name", "s_nationkey": "c_nationkey",
        "s_acctbal": "c_acctbal"})
    return ingest.conform(other, CUSTOMER)


RAW_EVENTS = """SELECT event_id, ts, user_id, event_type,
    CASE WHEN value >= 100 THEN value::INT || ' EUR' ELSE value::VARCHAR END AS value, props
    FROM events"""


def raw_events(spark, sf):
    """Events as they might arrive: large values are text that is not a number."""
    v = F.col("value")
    return read(spark, sf, "events").withColumn("value", F.when(
        v >= 100, F.concat(F.rint(v).cast("int").cast("string"), F.lit(" EUR"))
    ).otherwise(v.cast("string")))


@query("schema_report", f"""
    WITH r AS (SELECT *, try_cast(value AS DOUBLE) AS v FROM ({RAW_EVENTS}))
    SELECT 'event_id' AS field, 'long' AS kind, true AS present, count(*) AS n_rows,
           count(*) FILTER (event_id IS NULL) AS n_null, 0 AS n_uncast, 0 AS n_outside FROM r
    UNION ALL SELECT 'ts', 'datetime', true, count(*), count(*) FILTER (ts IS NULL), 0, 0 FROM r
    UNION ALL SELECT 'user_id', 'unsigned_long', true, count(*), 0, 0,
           count(*) FILTER (user_id <= 10) FROM r
    UNION ALL SELECT 'kind', 'keyword', true, count(*), 0, 0,
           count(*) FILTER (event_type NOT IN ('click', 'view', 'error', 'signup')) FROM r
    UNION ALL SELECT 'value', 'double', true, count(*), count(*) FILTER (value IS NULL),
           count(*) FILTER (v IS NULL AND value IS NOT NULL),
           count(*) FILTER (v < 0.5 OR v >= 250) FROM r
    UNION ALL SELECT 'props', 'keyword', true, count(*), 0, 0,
           count(*) FILTER (NOT regexp_matches(props, '^\\{{"k": [0-9]+\\}}$')) FROM r""")
def schema_report(spark, sf):
    return ingest.schema_report(raw_events(spark, sf), EVENT)


REASONS = f"""SELECT event_id, [x FOR x IN [
        CASE WHEN user_id <= 10 THEN 'user_id: not > 10' END,
        CASE WHEN length(event_type) > 6 THEN 'kind: longer than 6' END,
        CASE WHEN event_type NOT IN ('click', 'view', 'error', 'signup')
             THEN 'kind: not allowed' END,
        CASE WHEN try_cast(value AS DOUBLE) IS NULL THEN 'value: type' END,
        CASE WHEN try_cast(value AS DOUBLE) < 0.5 THEN 'value: not >= 0.5' END,
        CASE WHEN try_cast(value AS DOUBLE) >= 250 THEN 'value: not < 250' END
    ] IF x IS NOT NULL] AS reasons FROM ({RAW_EVENTS})"""


@query("validate_rows", f"""
    SELECT event_id, array_to_string(reasons, '; ') AS reasons, len(reasons) = 0 AS valid
    FROM ({REASONS})""")
def validate_rows(spark, sf):
    checked = ingest.validate(raw_events(spark, sf), EVENT)
    return checked.select("event_id", F.array_join("_reasons", "; ").alias("reasons"),
                          (F.size("_reasons") == 0).alias("valid"))


@query("reject_reasons", f"""
    SELECT reason, count(*) AS n FROM (SELECT unnest(reasons) AS reason FROM ({REASONS}))
    GROUP BY 1""")
def reject_reasons(spark, sf):
    return ingest.reject_reasons(ingest.validate(raw_events(spark, sf), EVENT))


@query("schema_evolve", """
    SELECT s_suppkey AS key, s_name AS name, s_acctbal AS balance, NULL::VARCHAR AS segment,
           'balance, name' AS unchanged, 'nation: int -> string' AS refused FROM supplier
    UNION ALL
    SELECT c_custkey, c_name, c_acctbal, c_mktsegment, 'balance, name',
           'nation: int -> string' FROM customer""")
def schema_evolve(spark, sf):
    """Old rows lack ``segment``; the new batch's ``nation`` changed type and is refused."""
    old = read(spark, sf, "supplier").toDF("key", "name", "nation", "balance")
    new = read(spark, sf, "customer").toDF("key", "name", "nation", "balance", "segment")
    merged, refused = ingest.evolve(old, new.withColumn("nation", F.col("nation").cast("string")))
    note = "; ".join(f"{f}: {a} -> {b}" for f, a, b in refused)
    return merged.select("key", "name", "balance", "segment",
                         F.lit("balance, name").alias("unchanged"), F.lit(note).alias("refused"))


@query("schema_evolve_nested", """
    SELECT event_id, event_type AS kind, user_id AS user, NULL::VARCHAR AS note, value AS x, NULL::VARCHAR AS y,
           'o.user: bigint -> string; l.x: double -> boolean' AS refused FROM events
    UNION ALL
    SELECT -event_id, event_type, NULL, 'n' || event_id, NULL, 'new',
           'o.user: bigint -> string; l.x: double -> boolean' FROM events""")
def schema_evolve_nested(spark, sf):
    """An object and a list of objects gain a field; one field of each changed its type and is refused."""
    rows = read(spark, sf, "events")
    old = rows.select("event_id", F.struct(F.col("event_type").alias("kind"), F.col("user_id").alias("user")).alias("o"),
                      F.array(F.struct(F.col("value").alias("x"))).alias("l"))
    new = rows.select(
        (-F.col("event_id")).alias("event_id"),
        F.array(F.struct(F.lit("new").alias("y"), F.lit(True).alias("x"))).alias("l"),
        F.struct(F.concat(F.lit("n"), F.col("event_id").cast("string")).alias("note"),
                 F.col("event_type").alias("kind"), F.col("user_id").cast("string").alias("user")).alias("o"))
    merged, refused = ingest.evolve(old, new)
    note = "; ".join(f"{f}: {a} -> {b}" for f, a, b in refused)
    return merged.select("event_id", "o.kind", "o.user", "o.note", F.col("l")[0]["x"].alias("x"),
                         F.col("l")[0]["y"].alias("y"), F.lit(note).alias("refused"))


DEEP = Spec("deep_event", (
    Field("event_id", "long"),
    Field("o", "object", None, fields=(
        Field("kind", alias="event_type", allowed=("click", "view", "error", "signup")), Field("user", "long", gt=10))),
    Field("l", "nested", None, fields=(Field("x", "double", None, lt=250), Field("y"))),
    Field("ns", "integer", None, many=True, ge=0),
), id_field="event_id")


@query("reject_reasons_nested", """
    WITH r AS (SELECT event_id, [x FOR x IN [
        CASE WHEN event_id % 11 <> 0 AND event_type NOT IN ('click', 'view', 'error', 'signup')
             THEN 'o.kind: not allowed' END,
        CASE WHEN event_id % 11 <> 0 AND event_id % 5 = 0 THEN 'o.user: type' END,
        CASE WHEN event_id % 11 <> 0 AND event_id % 5 <> 0 AND user_id <= 10 THEN 'o.user: not > 10' END,
        CASE WHEN event_id % 7 = 0 THEN 'l.x: type' END,
        CASE WHEN event_id % 3 = 0 THEN 'l.y: missing' END,
        CASE WHEN event_id % 7 <> 0 AND value >= 250 THEN 'l.x: not < 250' END,
        CASE WHEN event_id % 13 = 0 THEN 'ns: type' END,
        CASE WHEN event_id % 17 = 0 THEN 'ns: not >= 0' END] IF x IS NOT NULL] AS reasons FROM events)
    SELECT reason, count(*) AS n FROM (SELECT unnest(reasons) AS reason FROM r) GROUP BY 1""")
def reject_reasons_nested(spark, sf):
    """Broken values inside an object, a list of objects and a list of numbers."""
    at, v = F.col("event_id"), F.col("value")
    rows = read(spark, sf, "events").select(
        at, F.when(at % 11 != 0, F.struct("event_type", F.when(at % 5 == 0, F.lit("u1")).otherwise(
            F.col("user_id").cast("string")).alias("user"))).alias("o"),
        F.array(F.struct(F.lit("1").alias("x"), F.lit("y").alias("y")), F.struct(
            F.when(at % 7 == 0, F.lit("1 EUR")).otherwise(v.cast("string")).alias("x"),
            F.when(at % 3 != 0, F.lit("y")).alias("y"))).alias("l"),
        F.array(F.lit("1"), F.when(at % 13 == 0, F.lit("x")).otherwise(F.lit("2")),
                F.when(at % 17 == 0, F.lit("-1"))).alias("ns"))
    return ingest.reject_reasons(ingest.validate(rows, DEEP))


ORDER = Spec(
    "order", (Field("o_orderkey", "long"), Field("o_custkey", "long"), Field("o_orderstatus", "keyword"),
              Field("o_totalprice", "double", gt=0)),
    id_expr=lambda: F.concat_ws("-", "o_custkey", "o_orderkey"),
    routing_expr=lambda: F.col("o_orderstatus"),
    computed={"cents": lambda: F.rint(F.col("o_totalprice") * 100).cast("long")})


@query("sink_identity", """
    SELECT o_custkey || '-' || o_orderkey AS _id, o_orderstatus AS _routing, o_totalprice AS price,
           round(o_totalprice * 100)::BIGINT AS cents, false AS stored_computed, 20 AS made_length,
           (SELECT count(*) FROM orders) AS n_made
    FROM orders""")
def sink_identity(spark, sf):
    """Orders conformed, given computed ids and routes, written and read again; and how many different ids are made
    where a spec has none."""
    rows = ingest.conform(read(spark, sf, "orders").drop("o_orderdate", "o_orderpriority"), ORDER)
    path = f"{shared_folder(spark)}/sink-{uuid.uuid4().hex}"
    tables.write_routed(ORDER.with_routing(ORDER.with_id(rows)), path)
    stored = spark.read.parquet(path)
    made = Spec("bare", ORDER.fields).with_id(rows, position="o_orderkey").agg(
        F.max(F.length("_id")).alias("made_length"), F.count_distinct("_id").alias("n_made"))
    return ORDER.with_computed(stored).crossJoin(made).select(  # one row
        "_id", F.col("_routing").cast("string").alias("_routing"), F.col("o_totalprice").alias("price"), "cents",
        F.lit("cents" in stored.columns).alias("stored_computed"), "made_length", "n_made")


@query("conform", """
    SELECT event_id, ts, user_id::DECIMAL(20, 0)::VARCHAR AS user_id,
           coalesce(trim(nullif(event_type, 'view') || '  '), 'other') AS kind,
           value, NULL::VARCHAR AS props FROM events""")
def conform(spark, sf):
    """Alias renamed, strings trimmed, a default for the missing kind, no props delivered."""
    raw = read(spark, sf, "events").drop("props").withColumns({
        "event_type": F.concat(F.nullif("event_type", F.lit("view")), F.lit("  ")),
        "value": F.col("value").cast("string")})
    return ingest.conform(raw, EVENT).withColumn("user_id", F.col("user_id").cast("string"))


NESTED = Spec("nested_event", (
    Field("event_id", "long"),
    Field("o", "object", fields=(
        Field("kind", alias="event_type"), Field("user", "long"), Field("note", "text", "none"))),
    Field("l", "nested", None, fields=(Field("x", "long"), Field("y"))),
), id_field="event_id")


@query("conform_objects", """
    SELECT event_id, event_type AS kind, user_id AS user, 'none' AS note, user_id AS x, 't' AS y
    FROM events""")
def conform_objects(spark, sf):
    """Objects whose fields come in another order, under an alias, with blanks and as text."""
    user = F.col("user_id").cast("string")
    raw = read(spark, sf, "events").select(
        "event_id",
        F.struct(user.alias("user"), F.concat(F.lit(" "), "event_type", F.lit("  "))
                 .alias("event_type")).alias("o"),
        F.array(F.struct(F.lit(" t ").alias("y"), user.alias("x"))).alias("l"))
    out = ingest.conform(raw, NESTED)
    return out.select("event_id", "o.kind", "o.user", "o.note", F.col("l")[0]["x"].alias("x"),
                      F.col("l")[0]["y"].alias("y"))


STORED = Spec("stored", (
    Field("id", "long"), Field("name", "text", alias="full_name"), Field("raw", "binary"),
    Field("at", "datetime"), Field("day", "date"), Field("clock", "time"),
    Field("tags", "keyword", many=True),
    Field("where", "object", fields=(Field("nation", "integer"), Field("on", "datetime"))),
), id_field="id", routing_expr=lambda: F.col("where.nation"))


def stored_rows(spark, sf):
    events = read(spark, sf, "events")
    ts = F.col("ts")
    return events.select(
        F.col("event_id").alias("id"), F.col("event_type").alias("name"),
        F.encode("event_type", "UTF-8").alias("raw"), ts.alias("at"),
        ts.cast("date").alias("day"),
        (dates.ntz("1970-01-01") + (ts - dates.trunc("DAY", ts))).alias("clock"),
        F.array("event_type", F.lit("x")).alias("tags"),
        F.struct((F.col("user_id") % 25).cast("int").alias("nation"),
                 dates.trunc("DAY", ts).alias("on")).alias("where"))


ISO = """strftime({0}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond({0}) % 1000000 = 0 THEN ''
         ELSE strftime({0}, '.%f') END"""
CLOCK = "(TIMESTAMP '1970-01-01' + (ts - date_trunc('day', ts)))"


@query("encode_docs", f"""
    SELECT event_id::VARCHAR AS _id, (user_id % 25)::VARCHAR AS _routing,
        '{{"full_name":"' || event_type || '","raw":"' || to_base64(encode(event_type))
        || '","at":"' || {ISO.format('ts')} || 'Z","day":"' || strftime(ts, '%Y-%m-%d')
        || '","clock":"' || {ISO.format(CLOCK)}
        || '","tags":["' || event_type || '","x"],"where":{{"nation":' || (user_id % 25)
        || ',"on":"' || strftime(ts, '%Y-%m-%d') || 'T00:00:00Z"}}}}' AS doc
    FROM events""")
def encode_docs(spark, sf):
    return d.encode(stored_rows(spark, sf), STORED)


@query("decode_docs", f"""
    SELECT event_id AS id, event_type AS name, event_type AS raw, ts AS at,
           ts::DATE AS day, {CLOCK} AS clock, event_type || ',x' AS tags,
           (user_id % 25)::INT AS nation, date_trunc('day', ts)::TIMESTAMP AS on_day,
           event_id::VARCHAR AS _id
    FROM events""")
def decode_docs(spark, sf):
    """Stored and read back: the same typed rows."""
    back = d.decode(d.encode(stored_rows(spark, sf), STORED), STORED)
    return back.select(
        "id", "name", F.decode("raw", "UTF-8").alias("raw"), "at", "day", "clock",
        F.array_join("tags", ",").alias("tags"), F.col("where.nation").alias("nation"),
        F.col("where.on").alias("on_day"), "_id")


@query("subfields", """
    SELECT p_partkey, CASE WHEN length(p_name) <= 9 THEN p_name END AS name_keyword,
           lower(trim(p_type)) AS type_lowercase, p_retailprice::VARCHAR AS price_raw,
           array_to_string(regexp_split_to_array(lower(p_name), ' '), '|') AS name_words
    FROM part""")
def subfields(spark, sf):
    spec = Spec("part", (
        Field("p_name", "text", subfields={
            "keyword": {"type": "keyword", "ignore_above": 9}, "words": {"type": "text"}}),
        Field("p_type", subfields={"lowercase": {"type": "keyword", "normalizer": "lowercase"}}),
        Field("p_retailprice", "double", subfields={"raw": {"type": "keyword"}}),
    ))
    rows = ingest.with_subfields(read(spark, sf, "part"), spec)
    return rows.select(
        "p_partkey", F.col("p_name__keyword").alias("name_keyword"),
        F.col("p_type__lowercase").alias("type_lowercase"),
        F.col("p_retailprice__raw").alias("price_raw"),
        F.array_join("p_name__words", "|").alias("name_words"))


@query("routed_read", """
    SELECT c_custkey, c_name, c_mktsegment AS _routing FROM customer
    WHERE c_mktsegment = 'BUILDING'""")
def routed_read(spark, sf):
    """Written by route, then read for one route: only that folder is opened."""
    path = f"{shared_folder(spark)}/routed-{uuid.uuid4().hex}"
    rows = read(spark, sf, "customer").withColumnRenamed("c_mktsegment", "_routing")
    tables.write_routed(rows, path)
    return tables.read_routed(spark, path, "BUILDING").select("c_custkey", "c_name", "_routing")


@query("source_fields", """
    SELECT c_custkey, c_name, 0 AS c_nationkey, NULL::DOUBLE AS c_acctbal,
           'none' AS c_mktsegment FROM customer""")
def source_fields(spark, sf):
    spec = Spec("customer", (
        Field("c_custkey", "long"), Field("c_name", "text"), Field("c_nationkey", "integer", 0),
        Field("c_acctbal", "double", None), Field("c_mktsegment", "keyword", "none"),
    ), id_field="c_custkey")
    return d.select_fields(read(spark, sf, "customer"), spec, ["c_name"])


@query("nested_path", r"""
    SELECT event_id, regexp_extract(props, '"k": ([0-9]+)', 1)::BIGINT AS k FROM events
    WHERE regexp_extract(props, '"k": ([0-9]+)', 1)::BIGINT >= 40""")
def nested_path(spark, sf):
    rows = read(spark, sf, "events").withColumn("o", F.from_json("props", "k bigint"))
    return search(rows, c.range_("o.k", gte=40)).select("event_id", F.col("o.k").alias("k"))


@query("json_path", r"""
    SELECT regexp_extract(props, '"k": ([0-9]+)', 1) AS k, count(*) AS n FROM events GROUP BY 1""")
def json_path(spark, sf):
    rows = read(spark, sf, "events").select(F.get_json_object("props", "$.k").alias("k"))
    return rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))


@query("computed_field", """
    SELECT c_custkey, c_name || ' (' || c_mktsegment || ')' AS label,
           c_acctbal < 0 AS overdrawn FROM customer""")
def computed_field(spark, sf):
    spec = Spec("customer", CUSTOMER.fields, id_field="c_custkey", computed={
        "label": lambda: F.format_string("%s (%s)", "c_name", "c_mktsegment"),
        "overdrawn": lambda: F.col("c_acctbal") < 0})
    return spec.with_computed(read(spark, sf, "customer")).select(
        "c_custkey", "label", "overdrawn")


@query("keyed_result", "SELECT DISTINCT o_custkey::VARCHAR AS _id FROM orders")
def keyed_result(spark, sf):
    """One row per id, from a source that repeats ids."""
    rows = read(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("_id"))
    return p.keyed(rows)


@query("binary_roundtrip", """
    SELECT c_custkey, to_base64(encode(c_name)) AS coded, c_name AS back FROM customer""")
def binary_roundtrip(spark, sf):
    raw = F.encode("c_name", "UTF-8")
    return read(spark, sf, "customer").select(
        "c_custkey", F.base64(raw).alias("coded"),
        F.decode(F.unbase64(F.base64(raw)), "UTF-8").alias("back"))


@query("dt_math", """
    SELECT event_id, date_trunc('month', ts)::TIMESTAMP AS month,
           date_trunc('week', ts)::TIMESTAMP AS week, ts + INTERVAL 1 MONTH AS next_month,
           timezone('America/New_York', timezone('UTC', ts)) AS ny,
           TIMESTAMP '2024-02-01' - INTERVAL 1 WEEK AS floor_minus
    FROM events""")
def dt_math(spark, sf):
    ts = F.col("ts")
    return read(spark, sf, "events").select(
        "event_id", dates.trunc("MONTH", ts).alias("month"), dates.trunc("WEEK", ts).alias("week"),
        dates.shift(ts, 1, "MONTH").alias("next_month"),
        dates.to_zone(ts, "America/New_York").alias("ny"),
        dates.date_math("now/M-1w", "2024-02-20 08:00:00").alias("floor_minus"))

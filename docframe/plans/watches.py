"""Watches and windows, in their batch form over the events table."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import clauses as c
from ..operators import state
from ..sources import snapshots
from ..sources.lineage import shared_folder
from ..sources.tables import read
from ..streaming import watch as w
from ..streaming import windows
from .registry import query


@query("watch_input", r"""
    SELECT event_id, user_id, regexp_extract(props, '"k": ([0-9]+)', 1)::BIGINT AS o_k
    FROM events WHERE event_type = 'error' AND value >= 50
    ORDER BY value DESC, event_id LIMIT 200""")
def watch_input(spark, sf):
    rows = read(spark, sf, "events").withColumn("o", F.from_json("props", "k bigint"))
    return w.watch_input(
        rows, c.bool_(must=[c.term("event_type", "error"), c.range_("value", gte=50)]),
        ["event_id", "user_id", "o.k"], ("value", "desc"), "event_id", 200)


HOURLY = """SELECT time_bucket(INTERVAL 1 HOUR, ts, TIMESTAMP '1970-01-01') AS start, event_type,
    count(*) AS n, round(avg(value), 9) AS mean FROM events GROUP BY 1, 2"""


def hourly(spark, sf):
    return windows.window_metrics(
        read(spark, sf, "events"), "ts", "1 hour",
        {"n": F.count(F.lit(1)), "mean": F.round(F.avg("value"), 9)}, by=["event_type"])


@query("watch_compare", f"""
    SELECT start, event_type, n, mean FROM ({HOURLY})
    WHERE n >= 5 AND n < 40 AND event_type <> 'view' AND mean + n > 50""")
def watch_compare(spark, sf):
    payload = hourly(spark, sf)
    fires = w.compare("n", gte=5, lt=40) & w.compare("event_type", not_eq="view") & w.script(
        "mean + n > 50")
    return payload.where(fires).select("start", "event_type", "n", "mean")


@query("watch_array_compare", """
    SELECT page_id FROM pages
    WHERE len([x FOR x IN regexp_split_to_array(url, '[/?&=.#:]+') IF length(x) > 9]) > 0
      AND list_contains(regexp_split_to_array(url, '[/?&=.#:]+'), 'en')""")
def watch_array_compare(spark, sf):
    parts = F.transform(F.split("url", "[/?&=.#:]+"), lambda x: F.struct(
        x.alias("text"), F.length(x).alias("size")))
    rows = read(spark, sf, "pages").select("page_id", parts.alias("parts"))
    return rows.where(w.array_compare("parts", "size", gt=9)
                      & w.array_compare("parts", "text", eq="en")).select("page_id")


@query("watch_always_never", "SELECT 'always' AS rule, count(*) AS n FROM events")
def watch_always_never(spark, sf):
    events = read(spark, sf, "events")
    rows = events.where(w.always()).select(F.lit("always").alias("rule")).unionByName(
        events.where(w.never()).select(F.lit("never").alias("rule")))
    return rows.groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


@query("watch_transform_chain", """
    SELECT user_id, count(*) AS n, round(sum(value) * 1.2, 4) AS gross FROM events
    WHERE event_type = 'purchase' GROUP BY 1 HAVING count(*) >= 2""")
def watch_transform_chain(spark, sf):
    return w.chain(
        read(spark, sf, "events"),
        lambda df: df.where(c.term("event_type", "purchase").pred),
        lambda df: df.groupBy("user_id").agg(
            F.count(F.lit(1)).alias("n"), F.round(F.sum("value") * 1.2, 4).alias("gross")),
        lambda df: df.where(w.compare("n", gte=2)))


@query("watch_throttle", """
    WITH RECURSIVE e AS (
        SELECT event_type, ts, min(event_id) AS event_id FROM events GROUP BY 1, 2),
    f AS (
        SELECT event_type, min(ts) AS ts FROM e GROUP BY 1
        UNION ALL
        SELECT f.event_type, (SELECT min(ts) FROM e WHERE e.event_type = f.event_type
                              AND e.ts >= f.ts + INTERVAL 6 HOUR) FROM f WHERE f.ts IS NOT NULL)
    SELECT event_type, ts, event_id FROM f JOIN e USING (event_type, ts)""")
def watch_throttle(spark, sf):
    return w.throttle(read(spark, sf, "events"), "event_type", "ts", "event_id", "6h")


def _stream(spark, sf: str, name: str):
    """A table's files as a stream. The path is a pattern: a table may be one file or a folder."""
    shape = read(spark, sf, name).schema
    return spark.readStream.schema(shape).parquet(f"{sf}/{name}.parque[t]")


def _folder(spark) -> str:
    return f"{shared_folder(spark)}/stream-{uuid.uuid4().hex}"


@query("stream_throttle", """
    WITH RECURSIVE e AS (
        SELECT event_type, ts, min(event_id) AS event_id FROM events GROUP BY 1, 2),
    f AS (
        SELECT event_type, min(ts) AS ts FROM e GROUP BY 1
        UNION ALL
        SELECT f.event_type, (SELECT min(ts) FROM e WHERE e.event_type = f.event_type
                              AND e.ts >= f.ts + INTERVAL 6 HOUR) FROM f WHERE f.ts IS NOT NULL)
    SELECT event_type, ts, event_id FROM f JOIN e USING (event_type, ts)
    WHERE ts <= (SELECT time_bucket(INTERVAL 1 MILLISECOND, max(ts)) FROM events) - INTERVAL 1 HOUR""")
def stream_throttle(spark, sf):
    """The events as a stream: what fires up to an hour before the last one, which is decided by then."""
    root = _folder(spark)
    fired = w.throttle_stream(_stream(spark, sf, "events"), "event_type", "ts", "event_id", "6h", "1 hour")
    w.run(fired, w.index_action(root), f"{root}/checkpoint").awaitTermination()
    return w.read_alerts(spark, root).select("event_type", F.col("ts").cast("timestamp_ntz").alias("ts"), "event_id")


@query("stream_alerts", """
    SELECT event_id, user_id, value, 'user ' || user_id || ': event ' || event_id || ' at 100%' AS line
    FROM events WHERE event_type = 'error' AND value >= 20""")
def stream_alerts(spark, sf):
    """A watch on the stream of events: alerts go to a table and to a log."""
    root = _folder(spark)
    hits = w.watch_input(_stream(spark, sf, "events"), c.bool_(
        must=[c.term("event_type", "error"), c.range_("value", gte=20)]), ["event_id", "user_id", "value"])
    index, log = w.index_action(root), w.logging_action(root, "user {user_id}: event {event_id} at 100%")

    def act(batch, batch_id):
        index(batch, batch_id)
        log(batch, batch_id)

    w.run(hits, act, f"{root}/checkpoint").awaitTermination()
    lines = w.read_log(spark, root).select(
        F.col("value").alias("line"), F.regexp_extract("value", r"event (\d+)", 1).cast("long").alias("event_id"))
    return w.read_alerts(spark, root).join(lines, "event_id").select("event_id", "user_id", "value", "line")


@query("stream_upsert", """
    WITH o AS (SELECT event_id, user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n,
               row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS back FROM events)
    SELECT user_id::VARCHAR AS _id, value, n AS _version, event_type FROM o JOIN events USING (event_id, user_id, value)
    WHERE back = 1""")
def stream_upsert(spark, sf):
    """Events as writes of their users' rows, streamed into a versioned table."""
    root = _folder(spark)
    ops = _stream(spark, sf, "events").select(
        F.col("event_id").alias("op_order"), F.lit("index").alias("op"), F.col("user_id").cast("string").alias("_id"),
        "value", "event_type", F.lit(None).cast("long").alias("if_seq_no"),
        F.lit(None).cast("long").alias("if_primary_term"))
    w.run(ops, w.upsert_action(f"{root}/table"), f"{root}/checkpoint").awaitTermination()
    return snapshots.read(spark, f"{root}/table").select("_id", "value", "_version", "event_type")


@query("retention_purge", r"""
    SELECT doc_id, n_chars FROM (SELECT *, TIMESTAMP '2024-01-01' + INTERVAL 1 MINUTE * n_chars
                                 AS touched FROM documents)
    WHERE NOT (source LIKE 'src1%'
               AND touched <= TIMESTAMP '2024-01-03 06:00:00' - INTERVAL 3630 SECOND)""")
def retention_purge(spark, sf):
    """Drafts (by id pattern) not touched for 3630 seconds are removed."""
    rows = read(spark, sf, "documents").select("doc_id", "n_chars", "source", F.timestamp_add(
        "MINUTE", F.col("n_chars").cast("int"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).alias("touched"))
    old = c.bool_(filter=[c.wildcard("source", "src1*"),
                          c.range_("touched", lte="now-3630s", now="2024-01-03 06:00:00")])
    return state.delete_by_query(rows, old)[0].select("doc_id", "n_chars")


@query("win_tumbling", """
    SELECT time_bucket(INTERVAL 30 MINUTE, ts, TIMESTAMP '1970-01-01') AS start,
           time_bucket(INTERVAL 30 MINUTE, ts, TIMESTAMP '1970-01-01') + INTERVAL 30 MINUTE
               AS "end", event_type, count(*) AS n, round(sum(value), 4) AS total
    FROM events GROUP BY ALL""")
def win_tumbling(spark, sf):
    return windows.window_metrics(
        read(spark, sf, "events"), "ts", "30 minutes",
        {"n": F.count(F.lit(1)), "total": F.round(F.sum("value"), 4)}, by=["event_type"])


@query("win_sliding", """
    SELECT s AS start, s + INTERVAL 2 HOUR AS "end", count(*) AS n, max(value) AS top
    FROM (SELECT value, unnest([b, b - INTERVAL 30 MINUTE, b - INTERVAL 60 MINUTE,
                                b - INTERVAL 90 MINUTE]) AS s
          FROM (SELECT value, time_bucket(INTERVAL 30 MINUTE, ts, TIMESTAMP '1970-01-01') AS b
                FROM events)) GROUP BY 1""")
def win_sliding(spark, sf):
    return windows.window_metrics(
        read(spark, sf, "events"), "ts", "2 hours",
        {"n": F.count(F.lit(1)), "top": F.max("value")}, slide="30 minutes")


@query("win_session", """
    WITH m AS (SELECT *, coalesce(ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts)
                                  > INTERVAL 8 HOUR, true)::INT AS fresh FROM events),
    g AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS g FROM m)
    SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 8 HOUR AS "end", count(*) AS n,
           round(sum(value), 4) AS total FROM g GROUP BY user_id, g""")
def win_session(spark, sf):
    out = windows.sessions(read(spark, sf, "events"), "ts", "8h", "user_id", "value")
    return out.withColumn("total", F.round("total", 4))

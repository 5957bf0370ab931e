"""Versioned writes: customers as the stored table, orders as the batch of operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates
from ..operators import clauses as c
from ..operators import state as s
from ..operators.ranking import search
from ..sources.tables import read
from .registry import query

STATE_SQL = """SELECT c_custkey::VARCHAR AS _id, c_acctbal AS balance, c_mktsegment AS label,
    1 AS _version, c_custkey AS _seq_no, 1 AS _primary_term, c_acctbal < -900 AS _deleted
    FROM customer"""


def state(spark, sf):
    key, one = F.col("c_custkey"), F.lit(1).cast("long")
    return read(spark, sf, "customer").select(
        key.cast("string").alias("_id"), F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("label"), one.alias("_version"), key.alias("_seq_no"),
        one.alias("_primary_term"), (F.col("c_acctbal") < -900).alias("_deleted"))


# Every order is one operation on its customer. Low-priority orders go to ids not stored
# yet, urgent ones carry the stored sequence number, high ones a stale one.
OPS_SQL = """SELECT o_orderkey AS op_order,
    CASE WHEN o_orderstatus = 'P' THEN 'delete' ELSE 'index' END AS op,
    (o_custkey + CASE WHEN o_orderpriority = '5-LOW' THEN 10000000 ELSE 0 END)::VARCHAR AS _id,
    o_totalprice AS balance, o_orderpriority AS label,
    CASE o_orderpriority WHEN '1-URGENT' THEN o_custkey WHEN '2-HIGH' THEN o_custkey + 1 END
        AS if_seq_no,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 END AS if_primary_term
    FROM orders"""


def ops(spark, sf):
    key, rank = F.col("o_custkey"), F.col("o_orderpriority")
    return read(spark, sf, "orders").select(
        F.col("o_orderkey").alias("op_order"),
        F.when(F.col("o_orderstatus") == "P", "delete").otherwise("index").alias("op"),
        (key + F.when(rank == "5-LOW", 10_000_000).otherwise(0)).cast("string").alias("_id"),
        F.col("o_totalprice").alias("balance"), rank.alias("label"),
        F.when(rank == "1-URGENT", key).when(rank == "2-HIGH", key + 1).alias("if_seq_no"),
        F.when(rank.isin("1-URGENT", "2-HIGH"), F.lit(1).cast("long")).alias("if_primary_term"))


def results_sql(where: str = "true", ops_sql: str = OPS_SQL) -> str:
    """Outcome of every operation, in closed form over windows per id."""
    return f"""
    cur AS ({STATE_SQL}), ops AS (SELECT * FROM ({ops_sql}) WHERE {where}),
    a AS (SELECT o.*, coalesce(NOT cur._deleted, false) AS was_live,
                 coalesce(cur._version, 0) AS v0, o.if_seq_no IS NULL AS free,
                 coalesce(NOT cur._deleted AND o.if_seq_no = cur._seq_no
                          AND o.if_primary_term = cur._primary_term, false) AS hit
          FROM ops o LEFT JOIN cur USING (_id)),
    b AS (SELECT *, min(op_order) FILTER (free OR hit) OVER (PARTITION BY _id) AS first_touch
          FROM a),
    d AS (SELECT *, CASE WHEN free OR (hit AND op_order = first_touch) THEN op END AS kind FROM b),
    e AS (SELECT *, coalesce(last_value(kind IGNORE NULLS) OVER (
              PARTITION BY _id ORDER BY op_order
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) = 'index', was_live) AS alive
          FROM d),
    f AS (SELECT *, CASE WHEN kind IS NULL THEN false WHEN free AND op = 'delete' THEN alive
                         ELSE true END AS ok FROM e),
    r AS (SELECT *, CASE WHEN NOT ok AND NOT free THEN 'conflict'
                         WHEN op = 'delete' THEN CASE WHEN ok THEN 'deleted' ELSE 'not_found' END
                         WHEN alive THEN 'updated' ELSE 'created' END AS result,
                 CASE WHEN ok THEN v0 + sum(ok::INT) OVER (PARTITION BY _id ORDER BY op_order)
                      END::BIGINT AS new_version,
                 CASE WHEN ok THEN (SELECT max(_seq_no) FROM cur)
                      + sum(ok::INT) OVER (ORDER BY op_order) END::BIGINT AS new_seq_no
          FROM f)"""


def next_sql(where: str = "true", ops_sql: str = OPS_SQL) -> str:
    return f"""WITH {results_sql(where, ops_sql)},
    w AS (SELECT * FROM r WHERE ok QUALIFY row_number() OVER (
              PARTITION BY _id ORDER BY op_order DESC) = 1)
    SELECT _id,
           CASE WHEN w.op IS NULL THEN cur.balance WHEN w.op = 'index' THEN w.balance END
               AS balance,
           CASE WHEN w.op IS NULL THEN cur.label WHEN w.op = 'index' THEN w.label END AS label,
           coalesce(w.new_version, cur._version) AS _version,
           coalesce(w.new_seq_no, cur._seq_no) AS _seq_no, 1 AS _primary_term,
           coalesce(w.op = 'delete', cur._deleted) AS _deleted
    FROM cur FULL JOIN w USING (_id)"""


FREE = "if_seq_no IS NULL"
NEXT = ["_id", "balance", "label", "_version", "_seq_no", "_primary_term", "_deleted"]
OUT = ["op_order", "_id", "op", "result", "new_version", "new_seq_no"]
OUT_SQL = ", ".join(OUT)


@query("upsert", next_sql(f"{FREE} AND op = 'index'"))
def upsert(spark, sf):
    writes = ops(spark, sf).where(f"{FREE} AND op = 'index'")
    return s.apply_batch(state(spark, sf), writes)[0].select(NEXT)


@query("occ_accept", f"""
    WITH {results_sql("if_seq_no IS NOT NULL")} SELECT {OUT_SQL} FROM r WHERE ok""")
def occ_accept(spark, sf):
    done = s.outcomes(state(spark, sf), ops(spark, sf).where("if_seq_no IS NOT NULL"))
    return done.where("ok").select(OUT)


@query("occ_conflicts", f"""
    WITH {results_sql("if_seq_no IS NOT NULL")} SELECT {OUT_SQL} FROM r WHERE NOT ok""")
def occ_conflicts(spark, sf):
    done = s.outcomes(state(spark, sf), ops(spark, sf).where("if_seq_no IS NOT NULL"))
    return done.where("NOT ok").select(OUT)


@query("delete_rows", f"""
    WITH {results_sql("op = 'delete'")} SELECT {OUT_SQL} FROM r""")
def delete_rows(spark, sf):
    return s.outcomes(state(spark, sf), ops(spark, sf).where("op = 'delete'")).select(OUT)


@query("bulk_upsert", next_sql())
def bulk_upsert(spark, sf):
    return s.apply_batch(state(spark, sf), ops(spark, sf))[0].select(NEXT)


@query("bulk_delete", f"""
    WITH {results_sql("op = 'delete' AND " + FREE)}
    SELECT cur._id FROM cur WHERE NOT _deleted
      AND _id NOT IN (SELECT _id FROM r WHERE result = 'deleted')""")
def bulk_delete(spark, sf):
    after, _ = s.apply_batch(
        state(spark, sf), ops(spark, sf).where(f"op = 'delete' AND {FREE}"))
    return s.live(after).select("_id")


@query("bulk_same_id", f"WITH {results_sql()} SELECT {OUT_SQL} FROM r")
def bulk_same_id(spark, sf):
    """Customers with several operations in the batch: who wins, in which order."""
    return s.outcomes(state(spark, sf), ops(spark, sf)).select(OUT)


@query("bulk_errors", f"""
    WITH {results_sql()} SELECT op_order, _id, op, 409 AS status,
        '{s.CONFLICT}' AS error_type,
        'required seq_no ' || if_seq_no || ', stored '
            || coalesce((SELECT _seq_no::VARCHAR FROM cur WHERE cur._id = r._id), 'none')
            AS error_reason
    FROM r WHERE result = 'conflict'""")
def bulk_errors(spark, sf):
    return s.errors(s.outcomes(state(spark, sf), ops(spark, sf)))


@query("stamp_timestamps", """
    SELECT o_orderkey, coalesce(CASE WHEN o_orderstatus = 'F' THEN o_orderdate END,
                                TIMESTAMP '2024-05-01 10:00:00') AS created_at,
           TIMESTAMP '2024-05-01 10:00:00' AS modified_at,
           coalesce(CASE WHEN o_orderstatus = 'F' THEN o_orderdate END,
                    TIMESTAMP '2024-05-01 10:00:00') AS inner_created,
           TIMESTAMP '2024-05-01 10:00:00' AS inner_modified
    FROM orders""")
def stamp_timestamps(spark, sf):
    created = F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate"))
    rows = read(spark, sf, "orders").select(
        "o_orderkey", created.alias("created_at"),
        F.struct(created.alias("created_at"),
                 dates.ntz("2000-01-01").alias("modified_at")).alias("inner"))
    now = "2024-05-01 10:00:00"
    return s.stamp(s.stamp(rows, now), now, "inner").select(
        "o_orderkey", "created_at", "modified_at",
        F.col("inner.created_at").alias("inner_created"),
        F.col("inner.modified_at").alias("inner_modified"))


# Every order is an increment of its customer; low-priority ones go to ids not stored.
DELTAS_SQL = """SELECT (o_custkey + CASE WHEN o_orderpriority = '5-LOW' THEN 10000000 ELSE 0 END
    )::VARCHAR AS _id, o_totalprice AS amount FROM orders"""


@query("apply_deltas", f"""
    WITH cur AS ({STATE_SQL}),
    d AS (SELECT _id, sum(amount) AS amount, count(*) AS k FROM ({DELTAS_SQL}) GROUP BY 1)
    SELECT _id, round(balance + CASE WHEN k IS NULL OR _deleted THEN 0 ELSE amount END, 2) AS balance,
           _version + CASE WHEN k IS NULL OR _deleted THEN 0 ELSE k END AS _version, _deleted,
           k IS NOT NULL AND NOT _deleted AS renumbered,
           CASE WHEN k IS NULL THEN NULL WHEN _deleted THEN 'not_found' ELSE 'updated' END AS result,
           (SELECT max(_seq_no) + sum(CASE WHEN k IS NULL OR _deleted THEN 0 ELSE k END)
            FROM cur LEFT JOIN d USING (_id)) AS last_no
    FROM cur LEFT JOIN d USING (_id)
    UNION ALL
    SELECT _id, NULL, NULL, NULL, false, 'not_found',
           (SELECT max(_seq_no) + sum(CASE WHEN k IS NULL OR _deleted THEN 0 ELSE k END)
            FROM cur LEFT JOIN d USING (_id))
    FROM d WHERE _id NOT IN (SELECT _id FROM cur)""")
def apply_deltas(spark, sf):
    """Sequence numbers are shared out in no fixed order of ids, so the rows show which were
    renumbered and what the table's last number is."""
    rank = F.col("o_orderpriority")
    deltas = read(spark, sf, "orders").select(
        (F.col("o_custkey") + F.when(rank == "5-LOW", 10_000_000).otherwise(0)).cast("string")
        .alias("_id"), F.col("o_totalprice").alias("amount"))
    before = state(spark, sf)
    after, outcome = s.apply_deltas(before, deltas, "balance", "amount")
    rows = after.join(before.select("_id", F.col("_seq_no").alias("_was")), "_id").join(
        outcome.select(F.col("_id").alias("_asked"), "result"), F.col("_id") == F.col("_asked"),
        "full_outer")
    return rows.select(
        F.coalesce("_id", "_asked").alias("_id"), F.round("balance", 2).alias("balance"), "_version",
        "_deleted", F.coalesce(F.col("_seq_no") > F.col("_was"), F.lit(False)).alias("renumbered"),
        "result", F.lit(after.agg(F.max("_seq_no")).scalar()).alias("last_no"))


@query("delete_by_query", f"""
    WITH cur AS ({STATE_SQL}),
    n AS (SELECT _id, row_number() OVER (ORDER BY _seq_no) AS nth FROM cur
          WHERE NOT _deleted AND label = 'BUILDING' AND balance < 100)
    SELECT _id, CASE WHEN nth IS NULL THEN balance END AS balance,
           CASE WHEN nth IS NULL THEN _version ELSE _version + 1 END AS _version,
           CASE WHEN nth IS NULL THEN _seq_no ELSE (SELECT max(_seq_no) FROM cur) + nth END AS _seq_no,
           nth IS NOT NULL OR _deleted AS _deleted
    FROM cur LEFT JOIN n USING (_id)""")
def delete_by_query(spark, sf):
    after, _ = s.delete_matching(state(spark, sf), c.bool_(
        must=[c.term("label", "BUILDING"), c.range_("balance", lt=100)]))
    return after.select("_id", F.when(~F.col("_deleted") | (F.col("_version") == 1), F.col("balance"))
                        .alias("balance"), "_version", "_seq_no", "_deleted")


@query("hit_metadata", f"""
    SELECT _id, 2.0::DOUBLE AS _score, _version, _seq_no, _primary_term, _deleted
    FROM ({next_sql(FREE + " AND op = 'index'")}) WHERE label = '3-MEDIUM'""")
def hit_metadata(spark, sf):
    """Hits with the system columns that a batch of writes left behind."""
    writes = ops(spark, sf).where(f"{FREE} AND op = 'index'")
    after, _ = s.apply_batch(state(spark, sf), writes)
    hits = search(after, c.term("label", "3-MEDIUM", boost=2), scored=True)
    return hits.select("_id", "_score", "_version", "_seq_no", "_primary_term", "_deleted")

"""Versioned writes: a batch of operations applied to a table, with per-row outcomes.

State rows: ``_id``, document columns, ``_version``, ``_seq_no``, ``_primary_term``,
``_deleted`` (and ``_routing`` when used). Operations: ``op_order`` (unique, the order in
which they count), ``op`` (``index`` or ``delete``), ``_id``, document columns,
``if_seq_no`` and ``if_primary_term`` (null for unconditional operations).

One id may own a third of a batch, so no step gathers an id in one task: operations are
grouped by (id, slice of op_order), each slice is summed up in one row, the summaries are
scanned in order, and what they carry is joined back to the slices.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import ntz
from ..sources import lineage
from ..sources.lineage import cut
from .clauses import Clause

# Rows of one slice at most: op_order values are unique, so a slice of this many values
# cannot hold more rows.
SLICE = 100_000
# Error type of a failed condition, and the statuses of outcomes.
CONFLICT = "version_conflict_engine_exception"
STATUS = {"created": 201, "updated": 200, "deleted": 200, "not_found": 404, "conflict": 409}

BEFORE = (Window.unboundedPreceding, -1)
UP_TO = (Window.unboundedPreceding, Window.currentRow)
SYSTEM = ["_id", "_version", "_seq_no", "_primary_term", "_deleted", "_routing"]
OP = ["op_order", "op", "_id", "if_seq_no", "if_primary_term", "_routing"]


def empty_state(ops: DataFrame) -> DataFrame:
    docs = [c for c in ops.columns if c not in OP]
    extra = ["_routing"] if "_routing" in ops.columns else []
    return ops.select(
        "_id", *docs, *extra, F.lit(0).cast("bigint").alias("_version"),
        F.lit(0).cast("bigint").alias("_seq_no"), F.lit(1).cast("bigint").alias("_primary_term"),
        F.lit(False).alias("_deleted")).limit(0)


def prefix_sums(counts: DataFrame, slot: str, value: str, name: str) -> DataFrame:
    """Adds the sum of ``value`` over smaller ``slot`` numbers, in one ordered pass: there is a row per
    slot, and a slot stands for up to SLICE operations or for one in SLICE ids."""
    before = Window.orderBy(slot).rowsBetween(*BEFORE)
    return counts.withColumn(name, F.coalesce(F.sum(value).over(before), F.lit(0)))


def outcomes(current: DataFrame, ops: DataFrame, next_no: int | None = None) -> DataFrame:
    """Every operation with ``ok``, ``result``, ``status``, error, and new version numbers.

    A condition holds if it equals the stored numbers and nothing earlier in the batch has
    touched the row; unconditional writes always count; a delete needs a live row.

    Within a slice of an id everything is worked out for both cases, "not touched before
    this slice" (``_u``) and "touched before" (``_t``); which case it was, whether the row
    was alive then and how many writes came before is carried over the slices. The summaries and
    the rows they go back to share the one shuffle by (id, slice).

    ``current`` may hold just the rows the batch can touch; ``next_no`` is then the next
    operation number of the whole table.
    """
    # only stored rows that the batch names take part
    stored = current.join(ops.select("_id").distinct(), "_id", "left_semi").select(
        "_id", F.col("_version").alias("_cv"), F.col("_seq_no").alias("_cs"),
        F.col("_primary_term").alias("_cp"), (~F.col("_deleted")).alias("_was"))
    own = Window.partitionBy("_id", "_slice").orderBy("op_order")
    free, hit, is_delete = F.col("_free"), F.col("_hit"), F.col("op") == "delete"

    def number(c: Column) -> Column:
        return c.cast("long")

    rows = (
        ops.join(stored, "_id", "left")
        .withColumns({
            "_was": F.coalesce("_was", F.lit(False)),
            "_free": F.col("if_seq_no").isNull(),
            "_hit": F.coalesce(
                F.col("_was") & (F.col("if_seq_no") == F.col("_cs"))
                & (F.col("if_primary_term") == F.col("_cp")), F.lit(False)),
            "_slice": F.floor(F.col("op_order") / SLICE),
        })
        .repartition("_id", "_slice")
        .withColumn("_after", F.coalesce(
            F.max(free | hit).over(own.rowsBetween(*BEFORE)), F.lit(False)))
        .withColumns({
            "_kind_u": F.when(free | (hit & ~F.col("_after")), F.col("op")),
            "_kind_t": F.when(free, F.col("op")),
        })
        .withColumns({
            "_prev_u": F.last("_kind_u", ignorenulls=True).over(own.rowsBetween(*BEFORE)),
            "_prev_t": F.last("_kind_t", ignorenulls=True).over(own.rowsBetween(*BEFORE)),
        })
        .withColumns({
            "_ok_u": F.when(free & is_delete, F.coalesce(F.col("_prev_u") == "index",
                                                         F.col("_was")))
            .otherwise(F.col("_kind_u").isNotNull()),
            # a delete that comes first depends on what earlier slices left behind
            "_open": free & is_delete & F.col("_prev_t").isNull(),
            "_ok_t": F.when(free & is_delete, F.coalesce(F.col("_prev_t") == "index",
                                                         F.lit(False))).otherwise(free),
        })
        .withColumns({
            "_nth_u": F.sum(number(F.col("_ok_u"))).over(own.rowsBetween(*UP_TO)),
            "_nth_t": F.sum(number(F.col("_ok_t"))).over(own.rowsBetween(*UP_TO)),
        })
    )
    rows = lineage.stored(rows)  # they are summed up and joined with the sums: worked out once

    def last_kind(kind: str) -> Column:
        return F.max(F.when(F.col(kind).isNotNull(), F.struct("op_order", kind)))[kind]

    ordered = Window.partitionBy("_id").orderBy("_slice").rowsBetween(*BEFORE)
    touched = F.col("_touched")
    carried = (
        rows.groupBy("_id", "_slice").agg(
            F.max(free | hit).alias("_touch"), F.max("_was").alias("_start"),
            last_kind("_kind_u").alias("_last_u"), last_kind("_kind_t").alias("_last_t"),
            F.sum(number(F.col("_ok_u"))).alias("_n_u"),
            F.sum(number(F.col("_ok_t"))).alias("_n_t"), F.max("_open").alias("_opens"))
        .withColumn("_touched", F.coalesce(F.max("_touch").over(ordered), F.lit(False)))
        .withColumn("_left", F.when(touched, F.col("_last_t")).otherwise(F.col("_last_u")))
        .withColumn("_alive", F.coalesce(
            F.last("_left", ignorenulls=True).over(ordered) == "index", F.col("_start")))
        .withColumn("_extra", number(touched & F.col("_opens") & F.col("_alive")))
        .withColumn("_n", F.when(touched, F.col("_n_t") + F.col("_extra"))
                    .otherwise(F.col("_n_u")))
        .withColumn("_base", F.coalesce(F.sum("_n").over(ordered), F.lit(0)))
        .select("_id", "_slice", "_touched", "_alive", "_extra", "_base", "_n")
    )
    per_slice = carried.groupBy("_slice").agg(F.sum("_n").alias("_k"))
    starts = prefix_sums(per_slice, "_slice", "_k", "_from").select("_slice", "_from")
    rows = rows.join(carried.join(starts, "_slice").drop("_n"), ["_id", "_slice"])

    ok = F.when(touched, F.col("_ok_t") | (F.col("_open") & F.col("_alive"))).otherwise(
        F.col("_ok_u"))
    prev = F.when(touched, F.col("_prev_t")).otherwise(F.col("_prev_u"))
    live_before = F.coalesce(prev == "index", F.col("_alive"))
    result = (
        F.when(~free & ~F.col("ok"), "conflict")
        .when(is_delete & F.col("ok"), "deleted").when(is_delete, "not_found")
        .when(live_before, "updated").otherwise("created")
    )
    nth = F.when(touched, F.col("_nth_t") + F.col("_extra")).otherwise(F.col("_nth_u"))
    in_slice = Window.partitionBy("_slice").orderBy("op_order").rowsBetween(*UP_TO)
    start_no = F.lit(next_no) if next_no is not None else current.agg(
        F.coalesce(F.max("_seq_no") + 1, F.lit(0)).alias("n")).scalar()
    position = F.sum(number(F.col("ok"))).over(in_slice)
    status = F.element_at(
        F.create_map(*[x for k, v in STATUS.items() for x in (F.lit(k), F.lit(v))]),
        F.col("result"))
    failed = F.col("result") == "conflict"
    return rows.withColumn("ok", ok).withColumn("result", result).withColumns({
        "new_version": F.when(F.col("ok"), F.coalesce("_cv", F.lit(0)) + F.col("_base") + nth),
        "new_seq_no": F.when(F.col("ok"), start_no + F.col("_from") + position - 1),
        "status": status,
        "error_type": F.when(failed, F.lit(CONFLICT)),
        "error_reason": F.when(failed, F.concat(
            F.lit("required seq_no "), F.col("if_seq_no").cast("string"),
            F.lit(", stored "), F.coalesce(F.col("_cs").cast("string"), F.lit("none")))),
    }).select(*ops.columns, "ok", "result", "status", "error_type", "error_reason",
              "new_version", "new_seq_no")


def next_state(current: DataFrame, results: DataFrame) -> DataFrame:
    """The table after the batch; deleted rows stay as tombstones that keep their version. The stored
    table is joined from the left, so a small batch is broadcast and the table stays where it is."""
    docs = [c for c in current.columns if c not in SYSTEM]
    routed = ["_routing"] if "_routing" in current.columns else []
    carried = [c for c in [*docs, *routed] if c in results.columns]
    last = results.where("ok").groupBy("_id").agg(F.max_by(
        F.struct("op", "new_version", "new_seq_no", *carried), "op_order").alias("_w"))
    joined = current.join(last, "_id", "left")
    w = F.col("_w")
    written, removed = w.isNotNull(), w["op"] == "delete"

    def doc(c: str) -> Column:
        new = w[c] if c in carried else F.lit(None)
        return F.when(written, F.when(~removed, new)).otherwise(F.col(c)).alias(c)

    def kept(c: str) -> Column:
        return F.when(written & ~removed, w[c]).otherwise(F.col(c)).alias(c)

    known = joined.select(
        "_id", *[doc(c) for c in docs], *[kept(c) for c in routed if c in carried],
        F.coalesce(w["new_version"], F.col("_version")).alias("_version"),
        F.coalesce(w["new_seq_no"], F.col("_seq_no")).alias("_seq_no"), "_primary_term",
        F.when(written, removed).otherwise(F.col("_deleted")).alias("_deleted"),
    )
    kinds = dict(current.dtypes)

    def fresh(c: str) -> Column:
        new = F.when(~removed, w[c]) if c in carried else F.lit(None)
        return new.cast(kinds[c]).alias(c)

    created = last.join(current.select("_id"), "_id", "left_anti").select(
        "_id", *[fresh(c) for c in docs], *[w[c].alias(c) for c in routed if c in carried],
        w["new_version"].alias("_version"), w["new_seq_no"].alias("_seq_no"),
        F.lit(1).cast("bigint").alias("_primary_term"), removed.alias("_deleted"))
    return known.unionByName(created)


def apply_batch(current: DataFrame, ops: DataFrame,
                next_no: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(next state, outcome of every operation). The outcomes, as many as operations, are
    checkpointed: the state is made of them as well."""
    results = cut(outcomes(current, ops, next_no))
    return next_state(current, results), results


def live(state: DataFrame) -> DataFrame:
    return state.where(~F.col("_deleted"))


def errors(results: DataFrame) -> DataFrame:
    """The bulk error report: status, type, reason and row of each conflict."""
    return results.where(F.col("result") == "conflict").select(
        "op_order", "_id", "op", "status", "error_type", "error_reason")


def as_ops(df: DataFrame, op: str = "index") -> DataFrame:
    """Unconditional operations from rows with ``op_order`` and ``_id``."""
    return df.withColumns({
        "op": F.lit(op), "if_seq_no": F.lit(None).cast("bigint"),
        "if_primary_term": F.lit(None).cast("bigint")})


def stamp(df: DataFrame, as_of: str | datetime | Column, path: str | None = None) -> DataFrame:
    """``modified_at`` = ``as_of`` always, ``created_at`` only where it is null; at the top
    level or inside the object ``path``."""
    now = ntz(as_of)
    if path is None:
        return df.withColumns({
            "created_at": F.coalesce(F.col("created_at"), now), "modified_at": now})
    obj = F.col(path)
    made = obj.withField("created_at", F.coalesce(obj["created_at"], now)).withField(
        "modified_at", now)
    return df.withColumn(path, F.when(obj.isNotNull(), made))


def apply_deltas(current: DataFrame, deltas: DataFrame, column: str, delta: str,
                 next_no: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(next state, outcome per id) of concurrent increments: all of them count, each as one version
    with a sequence number of its own, so a writer that holds an older number conflicts.

    They are added up per id first (partially in every task); a row's last number is the start plus
    the increments of smaller ids and its own. Increments of a tombstone or of an id that is
    not stored change nothing and are reported as not_found (404)."""
    total = deltas.groupBy("_id").agg(
        F.sum(delta).alias("_d"), F.count(F.lit(1)).alias("_k"))
    known = current.select("_id", (~F.col("_deleted")).alias("_live"))
    touched = known.join(total.select("_id"), "_id", "left_semi")
    asked = cut(total.join(touched, "_id", "left").withColumn("_live", F.coalesce("_live", F.lit(False))))
    start = F.lit(next_no) if next_no is not None else current.agg(
        F.coalesce(F.max("_seq_no") + 1, F.lit(0))).scalar()
    slot = F.pmod(F.xxhash64("_id"), F.lit(SLICE))
    counted = asked.where("_live").withColumn("_slot", slot)
    per_slot = counted.groupBy("_slot").agg(F.sum("_k").alias("_ks"))
    starts = prefix_sums(per_slot, "_slot", "_ks", "_from").select("_slot", "_from")
    upto = Window.partitionBy("_slot").orderBy("_id").rowsBetween(*UP_TO)
    numbered = counted.join(starts, "_slot").select(
        "_id", "_d", "_k", (start + F.col("_from") + F.sum("_k").over(upto) - 1).alias("_no"))
    joined = current.join(numbered, "_id", "left")
    state = joined.withColumns({
        column: F.col(column) + F.coalesce("_d", F.lit(0)),
        "_version": F.col("_version") + F.coalesce("_k", F.lit(0)),
        "_seq_no": F.coalesce("_no", "_seq_no"),
    }).drop("_d", "_k", "_no")
    outcome = asked.select(
        "_id", F.col("_k").alias("increments"),
        F.when(F.col("_live"), "updated").otherwise("not_found").alias("result"),
        F.when(F.col("_live"), STATUS["updated"]).otherwise(STATUS["not_found"]).alias("status"))
    return state, outcome


def delete_by_query(table: DataFrame, query: Clause) -> tuple[DataFrame, DataFrame]:
    """(rows that stay, rows removed) of a table without versions."""
    return table.where(query.negated()), table.where(query.pred)


def delete_matching(current: DataFrame, query: Clause, next_no: int | None = None
                    ) -> tuple[DataFrame, DataFrame]:
    """(next state, outcomes): ``delete_by_query`` on a versioned table. Every live row that matches
    becomes a tombstone, one version and one sequence number on, as by a delete operation."""
    docs = [c for c in current.columns if c not in SYSTEM]
    hits = live(current).where(query.pred)
    ops = as_ops(hits.select("_id", *docs, F.col("_seq_no").alias("op_order")), "delete")
    return apply_batch(current, ops, next_no)

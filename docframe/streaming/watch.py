"""Watches: conditions on searched rows, throttled, with actions per micro-batch."""

from __future__ import annotations

import operator
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..functions.dates import duration_micros, epoch_micros, from_micros
from ..functions.text import col
from ..operators import paging, state
from ..operators.clauses import Clause
from ..operators.ranking import search
from ..sources import snapshots
from ..sources.lineage import cut

# The partition column of what actions write.
BATCH = "batch_id"

# Comparison names of conditions.
COMPARE = {
    "eq": operator.eq, "not_eq": operator.ne, "gt": operator.gt, "gte": operator.ge,
    "lt": operator.lt, "lte": operator.le,
}


def extract(df: DataFrame, paths: Sequence[str]) -> DataFrame:
    """Only the named (dotted) paths; ``a.b`` becomes column ``a_b``."""
    return df.select(*[F.col(p).alias(p.replace(".", "_")) for p in paths])


def watch_input(df: DataFrame, query: Clause, paths: Sequence[str], sort=None,
                tie: str | None = None, size: int | None = None) -> DataFrame:
    """Filter, then (for a batch) sort and page, then keep the named paths."""
    hits = search(df, query)
    if sort is not None:
        hits = paging.page(hits, sort, tie, size=size)
    return extract(hits, paths)


def compare(payload, **tests) -> Column:
    """``compare("total", gte=5, lt=100)``: every test holds."""
    out = F.lit(True)
    for name, value in tests.items():
        out = out & COMPARE[name](col(payload), value)
    return F.coalesce(out, F.lit(False))


def array_compare(array, path: str | None = None, **tests) -> Column:
    """Some element (or its field ``path``) passes every test."""
    return F.coalesce(
        F.exists(col(array), lambda x: compare(x[path] if path else x, **tests)), F.lit(False))


def always() -> Column:
    return F.lit(True)


def never() -> Column:
    return F.lit(False)


def script(expression: str) -> Column:
    return F.coalesce(F.expr(expression), F.lit(False))


def chain(df: DataFrame, *steps: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Transforms applied in order."""
    for step in steps:
        df = df.transform(step)
    return df


# ---- throttle ------------------------------------------------------------------------


def throttle(alerts: DataFrame, key: str, ts: str, id: str, period: str,
             last: DataFrame | None = None) -> DataFrame:
    """The alerts that fire: after one does, its key is silent for ``period``.

    Which alert fires depends on the one before, so a key is a chain; one key may hold a
    third of all alerts, so the chain is cut. Alerts are range-partitioned by (key, time)
    and pinned by a checkpoint. A key that runs over a partition's edge is summed up there
    as a map from "last fired before" to "last fired after"; those few maps (two rows per
    partition at most) are followed in order, and every partition then replays its own part
    from the moment it was handed. ``last`` may give (key, ts) fired before this batch.
    """
    wait = duration_micros(period)
    moments = alerts.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).groupBy(
        F.col(key).alias("k"), epoch_micros(F.col(ts)).alias("t")
    ).agg(F.min(id).alias("id"))  # alerts of the same moment: the lowest id
    if last is not None:
        before = last.groupBy(F.col(key).alias("k")).agg(
            (F.max(epoch_micros(F.col(ts))) + wait).alias("until"))
        silent = F.coalesce(F.col("t") < F.col("until"), F.lit(False))
        moments = moments.join(before, "k", "left").where(~silent).drop("until")
    parts = cut(
        moments.repartitionByRange("k", "t").sortWithinPartitions("k", "t")
        .withColumn("part", F.spark_partition_id()))
    # two rows per partition at most, so small enough to broadcast
    parts = parts.join(F.broadcast(_carried(parts, wait)), ["k", "part"], "left")
    ordered = parts.select("k", "t", "id", "carry")
    shape = f"k {_ddl(parts, 'k')}, t bigint, id {_ddl(parts, 'id')}"
    fired = ordered.mapInArrow(_replay(wait, parts), shape)
    return fired.select(F.col("k").alias(key), from_micros(F.col("t")).alias(ts),
                        F.col("id").alias(id))


def _ddl(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def _carried(parts: DataFrame, wait: int) -> DataFrame:
    """(k, part, carry) for the keys that continue from an earlier partition."""
    arrow_k = to_arrow_type(parts.schema["k"].dataType)

    def summary(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        keys, times, part = [], [], None
        for b in batches:
            if b.num_rows:
                keys.append(b.column(0))
                times.append(np.asarray(b.column(1)))
                part = b.column(2)[0].as_py()
        if not keys:
            return
        k = pa.chunked_array(keys, type=arrow_k)
        t = np.concatenate(times)
        for name in {k[0].as_py(), k[len(k) - 1].as_py()}:
            mask = np.asarray(pc.equal(k, pa.scalar(name, arrow_k)))
            mine = t[mask]
            nxt = np.searchsorted(mine, mine + wait)
            end = np.arange(len(mine))
            # follow the chain to its last member by doubling: log(n) array steps
            hop = np.where(nxt < len(mine), nxt, end)
            while True:
                far = hop[hop]
                if np.array_equal(far, hop):
                    break
                hop = far
            first = min(len(mine) - 1, int(np.searchsorted(mine, mine[0] + wait)))
            entries, exits = mine[: first + 1], mine[hop[: first + 1]]
            keep = np.flatnonzero(np.append(exits[1:] != exits[:-1], True))
            yield pa.RecordBatch.from_arrays([
                pa.array([name], arrow_k), pa.array([part], pa.int32()),
                pa.array([entries[keep].tolist()], pa.list_(pa.int64())),
                pa.array([exits[keep].tolist()], pa.list_(pa.int64())),
            ], names=["k", "part", "entries", "exits"])

    def follow(group):
        import numpy as np

        s, out = None, []
        for row in group.sort_values("part").itertuples():
            out.append((row.k, row.part, s))
            entries = np.asarray(row.entries)
            at = 0 if s is None else int(np.searchsorted(entries, s + wait))
            if at < len(entries):
                s = int(row.exits[at])
        import pandas as pd

        return pd.DataFrame(out, columns=["k", "part", "carry"]).astype({"carry": "Int64"})

    k = _ddl(parts, "k")
    edges = parts.select("k", "t", "part").mapInArrow(
        summary, f"k {k}, part int, entries array<bigint>, exits array<bigint>")
    carried = edges.groupBy("k").applyInPandas(follow, f"k {k}, part int, carry bigint")
    return carried.where(F.col("carry").isNotNull())


def _replay(wait: int, parts: DataFrame):
    arrow_k = to_arrow_type(parts.schema["k"].dataType)
    arrow_id = to_arrow_type(parts.schema["id"].dataType)

    def replay(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        key, fired = None, None
        for b in batches:
            if not b.num_rows:
                continue
            k, t, ids = b.column(0), np.asarray(b.column(1)), b.column(2)
            turns = np.flatnonzero(np.asarray(pc.not_equal(k[1:], k[:-1]))) + 1
            pick = []
            for lo, hi in zip([0, *turns.tolist()], [*turns.tolist(), len(k)], strict=True):
                name = k[lo].as_py()
                if name != key:
                    key, fired = name, b.column(3)[lo].as_py()
                at = lo
                while at < hi:  # one jump per alert that fires
                    if fired is not None:
                        at += int(np.searchsorted(t[at:hi], fired + wait))
                        if at >= hi:
                            break
                    fired = int(t[at])
                    pick.append(at)
                    at += 1
            if pick:
                at = pa.array(pick)
                yield pa.RecordBatch.from_arrays([
                    b.column(0).take(at).cast(arrow_k), b.column(1).take(at),
                    ids.take(at).cast(arrow_id)], names=["k", "t", "id"])

    return replay


# ---- running on a stream -------------------------------------------------------------


def run(stream: DataFrame, act: Callable[[DataFrame, int], None], checkpoint: str,
        interval: str | None = None):
    """Every ``interval`` (``"30 seconds"``), or once over what is there, ``act`` on the new
    rows of the watched stream."""
    writer = stream.writeStream.foreachBatch(act).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(
        availableNow=True)
    return writer.start()


def _batch_folder(root: str, name: str, batch_id: int) -> str:
    return f"{root}/{name}/{BATCH}={batch_id}"


def index_action(root: str, name: str = "watch"):
    """Appends each batch of alerts to the table ``root/name``, a partition per batch number; a replayed batch
    replaces its own, so alerts are in the table once."""

    def act(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(_batch_folder(root, name, batch_id))

    return act


def read_alerts(spark, root: str, name: str = "watch") -> DataFrame:
    """All alerts with the number of the batch that brought them."""
    return spark.read.parquet(f"{root}/{name}")


def logging_action(root: str, text: str, name: str = "log"):
    """Appends one line per alert to ``root/name``, as ``index_action`` does; ``text`` is a format string over
    the alert's columns."""

    def act(batch: DataFrame, batch_id: int) -> None:
        names = [c for c in batch.columns if "{" + c + "}" in text]
        names.sort(key=lambda c: text.index("{" + c + "}"))
        pattern = text.replace("%", "%%")
        for c in names:
            pattern = pattern.replace("{" + c + "}", "%s")
        line = F.format_string(pattern, *[F.col(c).cast("string") for c in names])
        batch.select(line.alias("line")).write.mode("overwrite").text(_batch_folder(root, name, batch_id))

    return act


def read_log(spark, root: str, name: str = "log") -> DataFrame:
    return spark.read.text(f"{root}/{name}")


def throttle_stream(stream: DataFrame, key: str, ts: str, id: str, period: str, late: str) -> DataFrame:
    """``throttle`` on a stream: (key, ts, id) of the alerts that fire, once no earlier alert can come any more.

    ``late`` is how long the stream waits for late alerts; later ones are dropped. Per key the state holds the last firing,
    up to when alerts are decided, and those that are not yet (one per moment, none inside the silence), at most what
    comes within ``late``: what lies further behind a key's newest alert is decided in its own batch, as the
    watermark is about to pass it. A timer decides the others when the watermark has passed them and drops a key
    that has been silent for the period. So state grows neither with the keys ever seen nor with the size of a batch,
    and a replayed batch fires what it fired before."""
    from pyspark.sql.streaming.state import GroupStateTimeout

    wait = duration_micros(period)
    lag = F.unix_micros(F.timestamp_micros(F.lit(0)) + F.expr(f"CAST('{late}' AS INTERVAL)"))
    rows = stream.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).select(
        F.col(key).alias("k"), F.col(ts).cast("timestamp").alias("at"),
        F.unix_micros(F.col(ts).cast("timestamp")).alias("t"), F.col(id).alias("id")).withColumn(
        "sure", F.col("t") - lag).withWatermark("at", late)
    kind = _ddl(rows, "id")

    def decide(name, batches, held):
        import numpy as np
        import pandas as pd

        passed = held.getCurrentWatermarkMs() * 1000
        last, upto, times, ids = held.get if held.exists else (None, passed, [], [])
        known = [pd.DataFrame({"t": times, "id": ids})] if times else []
        if not held.hasTimedOut:
            for b in batches:
                passed = max(passed, int(b["sure"].max()) // 1000 * 1000)
                known.append(b.loc[b["t"] > upto, ["t", "id"]])
        upto, passed = passed, held.getCurrentWatermarkMs() * 1000
        open_ = pd.concat(known) if known else pd.DataFrame({"t": [], "id": []})
        # alerts of the same moment: the lowest id
        open_ = open_.sort_values(["t", "id"]).drop_duplicates("t")
        t, ids = open_["t"].to_numpy(np.int64), open_["id"]
        sure, at, fired = int(np.searchsorted(t, upto, side="right")), 0, []
        while True:  # one jump per alert that fires
            at = 0 if last is None else int(np.searchsorted(t, last + wait))
            if at >= sure:
                break
            last = int(t[at])
            fired.append(at)
        rest = slice(max(at, sure), None)
        out = pd.DataFrame({"k": [name[0]] * len(fired), "t": t[fired], "id": ids.iloc[fired].to_numpy()})
        times, ids = t[rest].tolist(), ids.iloc[rest].tolist()
        if times or (last is not None and last + wait > passed):
            held.update((last, upto, times, ids))
            held.setTimeoutTimestamp((times[0] if times else last + wait) // 1000 + 1)
        elif held.exists:
            held.remove()
        yield out

    out = rows.groupBy("k").applyInPandasWithState(
        decide, f"k {_ddl(rows, 'k')}, t bigint, id {kind}",
        f"last bigint, upto bigint, times array<bigint>, ids array<{kind}>", "append",
        GroupStateTimeout.EventTimeTimeout)
    return out.select(F.col("k").alias(key), F.timestamp_micros("t").alias(ts), F.col("id").alias(id))


def purge_action(root: str, query: Clause, key: str = "_id"):
    """Deletes the rows of a table that match, as the next version. Rows that carry versions become
    tombstones, so a later write goes on from their version and sequence numbers. In a bucketed
    table only buckets that lose rows are rewritten."""

    def purged(table: DataFrame, next_no: int | None) -> tuple[DataFrame, int | None]:
        if "_version" not in table.columns:
            return state.delete_by_query(table, query)[0], next_no
        after, results = state.delete_matching(table, query, next_no)
        if next_no is None:
            return after, None
        return after, next_no + results.where("ok").count()

    def act(tick: DataFrame, batch_id: int) -> None:
        spark, name = tick.sparkSession, f"purge-{batch_id}"
        last = snapshots.latest(spark, root)
        if last is None or snapshots.committed(spark, root, name) is not None:
            return
        table, n = snapshots.read(spark, root), last["n_buckets"]
        if not n:
            snapshots.commit(purged(table, None)[0], root, name)
            return
        rows = state.live(table) if "_version" in table.columns else table
        losing = snapshots.touched(rows.where(query.pred), key, n)
        if losing:
            kept, following = purged(snapshots.read(spark, root, buckets=losing), last["next_seq"])
            snapshots.commit(kept, root, name, key, n, losing, following)

    return act


def upsert_action(root: str, n_buckets: int = 64, results_root: str | None = None):
    """Applies each micro-batch of operations to a versioned table; a replayed batch changes
    nothing, and the same operation delivered twice within one counts once. Only the buckets
    the batch's ids fall in are read and rewritten."""

    def act(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if snapshots.committed(spark, root, str(batch_id)) is not None:
            return
        ops = batch.dropDuplicates(["op_order"])
        last = snapshots.latest(spark, root)
        which = snapshots.touched(ops, "_id", n_buckets)
        if not which:
            return
        if last is None:
            current, next_no = state.empty_state(ops), 0
        else:
            current = snapshots.read(spark, root, buckets=which)
            next_no = last["next_seq"]
        results = cut(state.outcomes(current, ops, next_no))
        if results_root is not None:
            results.write.mode("overwrite").parquet(f"{results_root}/batch-{batch_id}")
        written = results.agg(F.max("new_seq_no")).first()[0]
        snapshots.commit(state.next_state(current, results), root, str(batch_id), "_id",
                         n_buckets, which, next_no if written is None else written + 1)

    return act

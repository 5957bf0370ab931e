"""Throttling, windows and running on a stream."""

import random

import pytest
from pyspark.sql import functions as F

from docframe.operators import clauses as c
from docframe.operators import state
from docframe.sources import snapshots
from docframe.streaming import watch as w
from docframe.streaming import windows


def alerts(spark, rows):
    df = spark.createDataFrame(rows, "k string, sec long, id long")
    return df.select("k", F.timestamp_add(
        "SECOND", "sec", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).alias("ts"), "id")


def greedy(rows, wait, last=None):
    first = {}
    for k, t, i in rows:
        first[(k, t)] = min(i, first.get((k, t), i))
    out, fired = [], dict(last or {})
    for (k, t), i in sorted(first.items()):
        if k not in fired or t >= fired[k] + wait:
            fired[k] = t
            out.append((k, t, i))
    return sorted(out)


def seconds(df):
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return sorted(tuple(r) for r in df.select(
        "k", F.timestamp_diff("SECOND", start, "ts"), "id").collect())


@pytest.mark.parametrize("seed", range(3))
def test_throttle_follows_a_hot_key_over_partitions(spark, seed):
    rng = random.Random(seed)
    rows = [("hot" if rng.random() < 0.6 else f"k{rng.randint(0, 30)}",
             rng.randint(0, 20_000), i) for i in range(6_000)]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = w.throttle(alerts(spark, rows), "k", "ts", "id", "97s")
        assert seconds(got) == greedy(rows, 97)
        last = {"hot": 50, "k3": 300}
        before = alerts(spark, [(k, t, 0) for k, t in last.items()])
        got = w.throttle(alerts(spark, rows), "k", "ts", "id", "97s", before)
        assert seconds(got) == greedy(rows, 97, last)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_throttled_stream_equals_the_batch(spark, tmp_path):
    """Alerts out of order, a late one, silent keys and a replayed batch."""
    rng = random.Random(9)
    rows = [(f"k{rng.randint(0, 3)}", t, t) for t in sorted(rng.sample(range(5_000), 150))]
    rows += [("once", 40, 9_000), ("once", 40, 8_999), (None, 50, 1)]
    rng.shuffle(rows)
    rows.sort(key=lambda r: r[1] // 300)  # at most 300 seconds out of order
    folder, out, point = (str(tmp_path / x) for x in ("in", "out", "checkpoint"))
    schema = alerts(spark, rows).schema

    def deliver(part):
        alerts(spark, part).coalesce(1).write.mode("append").parquet(folder)

    def drain():
        stream = spark.readStream.schema(schema).parquet(folder)
        fired = w.throttle_stream(stream, "k", "ts", "id", "600s", "300 seconds")
        w.run(fired, w.index_action(out), point).awaitTermination()
        found = w.read_alerts(spark, out).select("k", F.col("ts").cast("timestamp_ntz").alias("ts"), "id")
        return seconds(found)

    at = 0
    for size in (30, 50, 40, 33):
        deliver(rows[at:at + size])
        at += size
        drain()
    deliver([("k0", 100, 77_777)])  # far too late
    deliver([("end", 50_000, 1)])
    got = drain()
    want = greedy([r for r in rows if r[0] is not None], 600)
    assert [x for x in got if x[0] != "end"] == want
    done = sorted((tmp_path / "checkpoint" / "commits").glob("[0-9]*"), key=lambda f: int(f.name))
    for f in (done[-1], done[-1].with_name(f".{done[-1].name}.crc")):
        f.rename(tmp_path / f.name)  # as if the driver had died before the last commit
    assert drain() == got


def test_throttle_state_holds_what_may_still_change_only(spark, tmp_path):
    """A first batch, with no watermark yet, is decided but for what came within the wait for late alerts."""
    rows = [(f"k{i % 2}", i, i) for i in range(20_000)]
    folder, out, point = (str(tmp_path / x) for x in ("in", "out", "checkpoint"))
    alerts(spark, rows).write.parquet(folder)
    first = []

    def act(batch, batch_id):
        rows = batch.select("k", F.col("ts").cast("timestamp_ntz").alias("ts"), "id")
        first.append(seconds(rows))
        w.index_action(out)(batch, batch_id)

    fired = w.throttle_stream(spark.readStream.schema(alerts(spark, rows).schema).parquet(folder),
                              "k", "ts", "id", "600s", "300 seconds")
    w.run(fired, act, point).awaitTermination()
    assert first[0] == [r for r in greedy(rows, 600) if r[1] <= 20_000 - 300 - 2]
    state = spark.read.format("statestore").load(point).select("value.groupState.*")
    assert state.count() == 2 and all(len(r["times"]) <= 150 for r in state.collect())


def test_conditions(spark):
    df = spark.createDataFrame([(1, [1, 5]), (2, []), (3, None)], "n int, xs array<int>")

    def hits(cond):
        return sorted(r["n"] for r in df.where(cond).collect())

    assert hits(w.compare("n", gte=2, not_eq=3)) == [2]
    assert hits(w.array_compare("xs", gt=4)) == [1]
    assert hits(w.always()) == [1, 2, 3] and hits(w.never()) == []
    assert hits(w.script("size(xs) = 0")) == [2]
    with pytest.raises(KeyError):
        w.compare("n", above=3)


def write_events(spark, sf, folder):
    events = spark.read.parquet(f"{sf}/events.parquet").withColumn(
        "at", F.col("ts").cast("timestamp"))
    for i, part in enumerate(events.randomSplit([1.0, 1.0, 1.0], 5)):
        part.coalesce(1).write.mode("append").parquet(folder)
    return events


def test_stream_windows_equal_batch_windows(spark, sf, tmp_path):
    folder = str(tmp_path / "in")
    events = write_events(spark, sf, folder)
    metrics = {"n": F.count(F.lit(1)), "top": F.max("value")}
    stream = spark.readStream.schema(events.schema).parquet(folder)
    out = windows.window_metrics(stream, "at", "6 hours", metrics, by=["event_type"],
                                 late="40 days")
    q = out.writeStream.format("memory").queryName("win").outputMode("complete").trigger(
        availableNow=True).start()
    q.awaitTermination()
    got = sorted(map(tuple, spark.table("win").collect()))
    want = sorted(map(tuple, windows.window_metrics(
        events, "at", "6 hours", metrics, by=["event_type"]).collect()))
    assert got == want and got


def test_sessions_equal_session_window(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    got = windows.sessions(events, "ts", "8h", "user_id", "value")
    want = events.groupBy(F.session_window("ts", "8 hours").alias("w"), "user_id").agg(
        F.count(F.lit(1)).alias("n"))
    a = sorted((r["user_id"], r["start"], r["end"], r["n"]) for r in got.collect())
    b = sorted((r["user_id"], r["w"]["start"], r["w"]["end"], r["n"]) for r in want.collect())
    assert a == b


def test_late_rows_are_dropped_and_repeats_seen_once(spark, tmp_path):
    folder = str(tmp_path / "in")
    schema = "id long, at timestamp, day int"

    def deliver(rows):
        spark.createDataFrame(rows, "id long, at string, day int").withColumn(
            "at", F.col("at").cast("timestamp")).coalesce(1).write.mode("append").parquet(folder)

    def drain(stream, name, mode="append"):
        return stream.writeStream.format("memory").queryName(name).outputMode(mode).option(
            "checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()

    deliver([(1, "2024-01-01 10:00:00", 1), (1, "2024-01-01 10:00:00", 1)])
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    q = drain(windows.first_seen(stream, ["id"], "at", "1 hour"), "once")
    q.awaitTermination()
    assert spark.table("once").count() == 1
    deliver([(2, "2024-01-02 10:00:00", 2)])
    deliver([(3, "2024-01-01 10:00:00", 3)])  # a day late
    deliver([(4, "2024-01-05 10:00:00", 4)])
    counted = windows.window_metrics(stream, "at", "1 hour", {"n": F.count(F.lit(1))},
                                     late="1 hour")
    q = drain(counted, "late")
    q.awaitTermination()
    hours = {r["start"].day: r["n"] for r in spark.table("late").collect()}
    assert hours.get(2) == 1 and sum(hours.values()) <= 4


def test_streamed_upserts_equal_one_batch(spark, tmp_path):
    rng = random.Random(2)
    rows = [(i, rng.choice(["index", "index", "delete"]), f"i{rng.randint(0, 9)}", i, None, None)
            for i in range(60)]
    schema = "op_order long, op string, _id string, doc long, if_seq_no long, if_primary_term long"
    folder, root = str(tmp_path / "ops"), str(tmp_path / "table")
    for part in (rows[:20], rows[20:40], rows[40:]):
        spark.createDataFrame(part + part[:3], schema).coalesce(1).write.mode("append").parquet(
            folder)  # three operations are delivered twice
        stream = spark.readStream.schema(schema).parquet(folder)
        w.run(stream, w.upsert_action(root, n_buckets=4), str(tmp_path / "cp")).awaitTermination()
    ops = spark.createDataFrame(rows, schema)
    want, _ = state.apply_batch(state.empty_state(ops), ops)
    cols = ["_id", "doc", "_version", "_seq_no", "_deleted"]

    def key(df):
        return sorted(map(tuple, df.select(cols).collect()), key=str)

    assert key(snapshots.read(spark, root)) == key(want)
    last = snapshots.latest(spark, root)
    assert last["version"] == 3 and last["n_buckets"] == 4
    # a purge rewrites only the buckets that lose rows
    state_rows = snapshots.read(spark, root)
    victim = state_rows.where("NOT _deleted").orderBy("_id").first()["_id"]
    w.purge_action(root, c.term("_id", victim))(stream_tick(spark), 0)
    w.purge_action(root, c.term("_id", victim))(stream_tick(spark), 0)  # replayed
    last = snapshots.latest(spark, root)
    assert last["version"] == 4 and len(last["buckets"]) == 1
    after = snapshots.read(spark, root)
    assert key(after.where(F.col("_id") != victim)) == key(want.where(F.col("_id") != victim))
    gone, was = (d.where(F.col("_id") == victim).first() for d in (after, want))
    top = want.agg(F.max("_seq_no")).first()[0]
    assert (gone["_deleted"], gone["doc"], gone["_version"], gone["_seq_no"]) == (
        True, None, was["_version"] + 1, top + 1)
    assert key(snapshots.read(spark, root, 3)) == key(want)


def stream_tick(spark):
    return spark.range(1)


def test_purge_and_actions_on_a_stream(spark, tmp_path):
    root, ticks = str(tmp_path / "table"), str(tmp_path / "ticks")
    table = spark.range(10).select(F.col("id"), F.concat(
        F.when(F.col("id") < 4, "draft-").otherwise("doc-"), F.col("id")).alias("name"))
    snapshots.commit(table, root)
    spark.range(2).write.parquet(ticks)
    stream = spark.readStream.schema("id long").parquet(ticks)
    w.run(stream, w.purge_action(root, c.wildcard("name", "draft-*")),
          str(tmp_path / "cp1")).awaitTermination()
    assert snapshots.read(spark, root).count() == 6
    out = str(tmp_path / "alerts")
    w.run(stream.where("id > 0"), w.index_action(out), str(tmp_path / "cp2")).awaitTermination()
    assert [r["id"] for r in w.read_alerts(spark, out).collect()] == [1]
    logs = str(tmp_path / "log")
    w.run(stream, w.logging_action(logs, "row {id} seen"), str(tmp_path / "cp3"),
          interval="1 second").stop()
    w.run(stream, w.logging_action(logs, "row {id} seen"),
          str(tmp_path / "cp4")).awaitTermination()
    lines = sorted(r["value"] for r in w.read_log(spark, logs).where("batch_id = 0").collect())
    assert lines == ["row 0 seen", "row 1 seen"]

"""Versioned writes against a plain sequential simulation, and the literal facts."""

import random

import pytest
from pyspark.sql import functions as F

from docframe.operators import clauses as c
from docframe.operators import state as s
from docframe.sources import snapshots
from docframe.sources.lineage import cut

STATE = ("_id string, doc long, _version long, _seq_no long, _primary_term long, _deleted boolean")
OPS = "op_order long, op string, _id string, doc long, if_seq_no long, if_primary_term long"


def simulate(stored, ops):
    """One operation after the other, as a server would apply them."""
    rows = {r[0]: dict(doc=r[1], v=r[2], seq=r[3], term=r[4], dead=r[5]) for r in stored}
    at_start = {k: dict(r) for k, r in rows.items()}
    seq = max([r[3] for r in stored], default=-1) + 1
    out = []
    for order, op, _id, doc, if_seq, if_term in sorted(ops):
        row = rows.get(_id)
        alive = row is not None and not row["dead"]
        if if_seq is not None and not (alive and row["seq"] == if_seq and row["term"] == if_term
                                       and at_start.get(_id, {}).get("seq") == row["seq"]):
            out.append((order, "conflict", None, None))
            continue
        if op == "delete" and not alive:
            out.append((order, "not_found", None, None))
            continue
        version = (row["v"] if row else 0) + 1
        rows[_id] = dict(doc=doc if op == "index" else None, v=version, seq=seq, term=1,
                         dead=op == "delete")
        out.append((order, "deleted" if op == "delete" else "updated" if alive else "created",
                    version, seq))
        seq += 1
    return out, rows


def random_case(rng, n_ops, n_ids, hot):
    ids = [f"i{k}" for k in range(n_ids)]
    stored = [(i, rng.randint(0, 9), rng.randint(1, 4), k, 1, rng.random() < 0.3)
              for k, i in enumerate(ids) if rng.random() < 0.7]
    seqs = {r[0]: r[3] for r in stored}
    ops = []
    for order in rng.sample(range(n_ops * 3), n_ops):
        i = ids[0] if rng.random() < hot else rng.choice(ids)
        cond = rng.random() < 0.4
        want = seqs.get(i, 0) + (0 if rng.random() < 0.7 else 1) if cond else None
        ops.append((order, rng.choice(["index", "index", "delete"]), i, order, want,
                    1 if cond else None))
    return stored, ops


@pytest.mark.parametrize("seed", range(4))
def test_batch_equals_simulation_with_hot_ids_over_many_slices(spark, monkeypatch, seed):
    monkeypatch.setattr(s, "SLICE", 7)
    rng = random.Random(seed)
    stored, ops = random_case(rng, 220, 12, hot=0.4)
    current, batch = spark.createDataFrame(stored, STATE), spark.createDataFrame(ops, OPS)
    after, results = s.apply_batch(current, batch)
    want, rows = simulate(stored, ops)
    got = [(r["op_order"], r["result"], r["new_version"], r["new_seq_no"])
           for r in results.orderBy("op_order").collect()]
    # an unconditional delete of a row that is not there still blocks later conditions
    assert [g for g, w in zip(got, want)] == want
    final = {r["_id"]: (r["doc"], r["_version"], r["_seq_no"], r["_deleted"])
             for r in after.collect()}
    assert final == {k: (r["doc"], r["v"], r["seq"], r["dead"]) for k, r in rows.items()}


def create(spark, *rows):
    return spark.createDataFrame([(i, "index", k, d, None, None) for i, (k, d) in enumerate(rows)],
                                 OPS)


def test_first_write_then_update(spark):
    first = create(spark, *[(f"a{i}", i) for i in range(5)])
    table = cut(s.apply_batch(s.empty_state(first), first)[0])
    rows = {r["_id"]: r for r in table.collect()}
    assert [rows[f"a{i}"]["_seq_no"] for i in range(5)] == [0, 1, 2, 3, 4]
    assert {r["_version"] for r in rows.values()} == {1}
    assert {r["_primary_term"] for r in rows.values()} == {1}
    again, _ = s.apply_batch(table, create(spark, ("a0", 9)))
    a0 = again.where("_id = 'a0'").first()
    assert (a0["_version"], a0["_seq_no"], a0["doc"]) == (2, 5, 9)


def test_stale_second_write_conflicts(spark):
    start = create(spark, ("x", 1))
    table = cut(s.apply_batch(s.empty_state(start), start)[0])
    both = spark.createDataFrame([(0, "index", "x", 2, 0, 1), (1, "index", "x", 3, 0, 1)], OPS)
    after, results = map(cut, s.apply_batch(table, both))
    x = after.first()
    assert (x["doc"], x["_version"], x["_seq_no"]) == (2, 2, 1)
    bad = s.errors(results).collect()
    assert len(bad) == 1 and bad[0]["op_order"] == 1 and bad[0]["status"] == 409
    assert bad[0]["error_type"] == "version_conflict_engine_exception"
    # applying the same conditional batch again conflicts throughout
    assert s.errors(s.outcomes(after, both)).count() == 2


def test_delete_of_missing_row(spark):
    ops = spark.createDataFrame([(0, "delete", "nope", None, None, None)], OPS)
    r = s.outcomes(s.empty_state(ops), ops).first()
    assert (r["result"], r["status"]) == ("not_found", 404)


@pytest.mark.parametrize("steps, total", [([1, 1, 1], 13), ([1, 2, 3], 16)])
def test_concurrent_increments_all_count(spark, steps, total):
    table = spark.createDataFrame([("x", 10, 1, 0, 1, False)], STATE)
    deltas = spark.createDataFrame([("x", d) for d in steps], "_id string, by long")
    after, _ = s.apply_deltas(table, deltas, "doc", "by")
    r = after.first()
    assert (r["doc"], r["_version"], r["_seq_no"]) == (total, 4, 3)
    # a writer that still holds the old number conflicts
    ops = spark.createDataFrame([(0, "index", "x", 99, 0, 1)], OPS.replace("doc string", "doc long"))
    assert s.outcomes(after, ops).first()["result"] == "conflict"


def test_increments_leave_tombstones_and_report_unknown_ids(spark):
    table = spark.createDataFrame([("x", 10, 1, 0, 1, False), ("t", 1, 2, 1, 1, True)], STATE)
    deltas = spark.createDataFrame([("t", 3), ("u", 4), ("x", 1)], "_id string, by long")
    after, outcome = s.apply_deltas(table, deltas, "doc", "by")
    assert {r["_id"]: (r["doc"], r["_version"], r["_seq_no"]) for r in after.collect()} == {
        "x": (11, 2, 2), "t": (1, 2, 1)}
    assert {r["_id"]: r["result"] for r in outcome.collect()} == {
        "t": "not_found", "u": "not_found", "x": "updated"}


def test_delete_matching_leaves_tombstones(spark):
    table = spark.createDataFrame([("x", 10, 1, 0, 1, False), ("y", 1, 2, 1, 1, False)], STATE)
    after, results = s.delete_matching(table, c.range_("doc", gt=5))
    rows = {r["_id"]: (r["_version"], r["_seq_no"], r["_deleted"]) for r in after.collect()}
    assert rows == {"x": (2, 2, True), "y": (2, 1, False)}
    assert results.first()["result"] == "deleted"


def test_stamp(spark):
    df = spark.sql("""SELECT 1 AS id, CAST(NULL AS timestamp_ntz) AS created_at,
                             CAST(NULL AS timestamp_ntz) AS modified_at""")
    first = s.stamp(df, "2024-01-01 00:00:00")
    r = first.first()
    assert r["created_at"] == r["modified_at"]
    r2 = s.stamp(first, "2024-01-02 00:00:00").first()
    assert r2["created_at"] == r["created_at"] and r2["modified_at"] > r["modified_at"]


def test_prefix_sums(spark):
    rng = random.Random(1)
    slots = rng.sample(range(50_000), 400)
    df = spark.createDataFrame([(k, rng.randint(0, 5)) for k in slots], "slot long, n long")
    rows = sorted(df.collect())
    want, run = {}, 0
    for k, n in rows:
        want[k] = run
        run += n
    got = {r["slot"]: r["p"] for r in s.prefix_sums(df, "slot", "n", "p").collect()}
    assert got == want


def test_snapshots_are_atomic_and_replay_safe(spark, tmp_path):
    root = str(tmp_path / "table")
    assert snapshots.read(spark, root) is None
    one = spark.range(3).select(F.col("id").alias("x"))
    assert snapshots.commit(one, root, "b0") == 1
    assert snapshots.commit(one.where("x < 2"), root, "b1") == 2
    assert snapshots.commit(one.where("x < 1"), root, "b1") == 2  # replayed: ignored
    assert snapshots.read(spark, root).count() == 2
    assert snapshots.read(spark, root, 1).count() == 3
    # an orphan folder of a failed write is never read, and is written over later
    one.write.parquet(f"{root}/v3")
    assert snapshots.read(spark, root).count() == 2
    assert snapshots.commit(one.where("x < 1"), root, "b2") == 3
    assert snapshots.read(spark, root).count() == 1

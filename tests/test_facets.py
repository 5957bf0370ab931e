"""Facets, paging, lookups: literal facts, invariants and brute force."""

import bisect
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from docframe.operators import facets as f
from docframe.operators import lookup as lk
from docframe.operators import paging as p
from docframe.operators import ranking as r
from docframe.operators import sketches as s
from docframe.operators import clauses as c
from docframe.operators import vectors as v
from docframe.operators.running import range_table

from conftest import plan


@pytest.fixture(scope="module")
def four(spark):
    return spark.createDataFrame([(i, (i,)) for i in (2, 3, 4, 5)],
                                 "id long, f_nested struct<f_int:long>")


def test_metrics_of_a_nested_field(four):
    m = f.metrics(four, total=f.sum_("f_nested.f_int"), mean=f.avg("f_nested.f_int"),
                  low=f.min_("f_nested.f_int"), high=f.max_("f_nested.f_int")).first()
    assert (m["total"], m["mean"], m["low"], m["high"]) == (14, 3.5, 2, 5)
    assert [tuple(x) for x in f.terms(four, "f_nested.f_int").collect()] == [
        (2, 1), (3, 1), (4, 1), (5, 1)]
    some = f.metrics(four, c.range_("f_nested.f_int", gte=4), total=f.sum_("f_nested.f_int"))
    assert some.first()["total"] == 9
    assert f.count(four, c.range_("f_nested.f_int", gte=4)).first()["count"] == 2


def test_pages(four):
    def page(n):
        return [x["id"] for x in p.page(four, "id", "id", n, 2).collect()]

    assert (page(1), page(2), page(3)) == ([2, 3], [4, 5], [])
    assert p.page_size(None) == 10 and p.page_size(50_000) == 50_000
    assert p.refuse_over(7, 5) == 7 and p.refuse_over(None, 5) is None
    with pytest.raises(ValueError):
        p.refuse_over(11, 5)
    first = p.page(four, ("id", "desc"), "id", size=3).collect()
    after = p.page_after(four, ("id", "desc"), "id", (first[-1]["id"], first[-1]["id"]))
    assert [x["id"] for x in after.collect()] == [2]
    assert p.page_with_total(four, "id", "id", 2, 3).first()["total"] == 4


def test_missing_values_sort_last_both_ways(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 7)], "id int, n int")
    assert [x["id"] for x in p.sort_rows(df, "n").collect()] == [1, 3, 2]
    assert [x["id"] for x in p.sort_rows(df, ("n", "desc")).collect()] == [3, 1, 2]


@pytest.mark.parametrize("seed", range(4))
def test_percentiles_are_exact_whatever_the_distribution(spark, seed):
    rng = random.Random(seed)
    n = rng.choice([1, 7, 5_000])
    values = [rng.choice([lambda: rng.gauss(0, 1), lambda: 5.0, lambda: float(rng.randint(0, 9)),
                          lambda: rng.lognormvariate(3, 2)])() for _ in range(n)]
    if n > 100:
        values += [42.0] * (n // 2)  # one value holds a third of all rows
    rng.shuffle(values)
    df = spark.createDataFrame([(x,) for x in values] + [(None,)], "v double")
    wanted = [0, 1, 33.3, 50, 90, 99.9, 100]
    got = {x["percent"]: x["value"]
           for x in f.percentiles(df, "v", wanted).collect()}
    ordered = sorted(values)
    for q in wanted:
        at = q / 100 * (len(ordered) - 1)
        lo, hi = ordered[int(at)], ordered[min(int(at) + 1, len(ordered) - 1)]
        assert got[float(q)] == pytest.approx(lo + (hi - lo) * (at - int(at)), abs=1e-9)
    near = {x["percent"]: x["value"] for x in f.percentiles(df, "v", wanted, interpolate=False).collect()}
    for q in wanted:
        assert near[float(q)] == ordered[max(0, math.ceil(q / 100 * len(ordered)) - 1)]
    assert f.percentiles(df.where("v is null"), "v", wanted).collect() == []


def test_percentiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert f.percentiles(df, "v").count() == 0
    assert {x["value"] for x in f.percentiles(df, "v", missing=3.0).collect()} == {3.0}


def test_sketches_stay_within_their_error(spark, sf):
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    exact = lines.select("l_orderkey").distinct().count()
    approx = lines.agg(f.approx_cardinality("l_orderkey").alias("n")).first()["n"]
    assert abs(approx - exact) <= 3 * 1.04 / 3000 ** 0.5 * exact
    true = {x["percent"]: x["value"] for x in f.percentiles(lines, "l_extendedprice").collect()}
    for x in f.approx_percentiles(lines, "l_extendedprice").collect():
        assert x["value"] == pytest.approx(true[x["percent"]], rel=0.02)
    merged = lines.groupBy("l_returnflag").agg(f.distinct_sketch("l_orderkey").alias("s")).agg(
        F.hll_sketch_estimate(F.hll_union_agg("s")).alias("n")).first()["n"]
    assert abs(merged - exact) < 0.1 * exact
    assert lines.agg(f.percentile_sketch("l_quantity").alias("s")).first()["s"] is not None


def test_histogram_invariants(spark, sf):
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")
    h = f.histogram(lines, "l_quantity", 7, extended_bounds=(-30, 100)).collect()
    assert sum(x["doc_count"] for x in h) == lines.count()
    keys = sorted(x["key"] for x in h)
    assert keys[0] == -35 and keys[-1] == 98
    assert all(b - a == 7 for a, b in zip(keys, keys[1:]))


def test_date_histogram_over_a_clock_change(spark):
    df = spark.sql("""SELECT explode(sequence(timestamp_ntz'2024-03-30 00:00:00',
        timestamp_ntz'2024-04-01 23:00:00', interval 1 hour)) AS ts""")
    days = f.date_histogram(df, "ts", calendar_interval="day", time_zone="Europe/Paris",
                            min_doc_count=1).orderBy("key").collect()
    # Sunday 31 March had 23 hours in Paris
    assert [x["doc_count"] for x in days] == [23, 23, 24, 2]
    assert [x["key"].hour for x in days] == [23, 23, 22, 22]
    fixed = f.date_histogram(df, "ts", fixed_interval="90m", offset="30m").collect()
    assert sum(x["doc_count"] for x in fixed) == 72
    with pytest.raises(ValueError):
        f.date_histogram(df, "ts")


def test_ranges(spark):
    df = spark.createDataFrame([(x,) for x in (5.0, 10.0, 15.0, None)], "v double")
    got = {x["key"]: x["doc_count"] for x in f.ranges(
        df, "v", [{"to": 10}, {"from": 10, "to": 20}, {"from": 5}, {"from": 99}]).collect()}
    assert got == {"*-10.0": 1, "10.0-20.0": 2, "5.0-*": 3, "99.0-*": 0}


def test_terms_on_lists_count_once_per_row(spark):
    df = spark.createDataFrame([(["a", "a", "b"],), (["b"],), (None,)], "tags array<string>")
    assert [tuple(x) for x in f.terms(df, "tags", is_list=True).collect()] == [("b", 2), ("a", 1)]
    assert df.agg(f.value_count("tags", is_list=True).alias("n")).first()["n"] == 4


def test_lookup_of_equal_values(spark):
    df = spark.createDataFrame([(1, "x"), (2, "x"), (3, "x"), (4, "y"), (5, "z"), (6, None)],
                               "id int, f string")
    step = lk.Lookup("same", df, "f", "f", ["id"], "id", "id")
    got = {x["id"]: ([y["id"] for y in x["same"]], x["same_total"])
           for x in lk.lookup(df, step).collect()}
    assert got[1] == got[2] == got[3] == ([1, 2, 3], 3)
    assert got[4] == ([4], 1) and got[5] == ([5], 1) and got[6] == ([], 0)
    short = lk.lookup(df, lk.Lookup("same", df, "f", "f", ["id"], ("id", "desc"), "id", 2))
    assert {x["id"]: ([y["id"] for y in x["same"]], x["same_total"])
            for x in short.collect()}[1] == ([3, 2], 3)


def test_get_and_reload(spark):
    docs = spark.createDataFrame([("a", 1), ("b", None)], "_id string, n int")
    ids = spark.createDataFrame([("a",), ("c",)], "_id string")
    assert {x["_id"]: x["found"] for x in lk.get_by_ids(ids, docs, "_id").collect()} == {
        "a": True, "c": False}
    assert [x["_id"] for x in lk.get_missing(ids, docs, "_id").collect()] == ["c"]
    stale = spark.createDataFrame([("a", 9), ("b", 9), ("c", 9)], "_id string, n int")
    assert {x["_id"]: x["n"] for x in lk.reload(stale, docs).collect()} == {
        "a": 1, "b": None, "c": 9}


def test_bm25_prefers_rare_tokens_and_short_texts(spark):
    df = spark.createDataFrame([(1, "common rare"), (2, "common common common words here"),
                                (3, "common"), (4, "rare and much longer text than the others")],
                               "id int, text string")
    s = {x["id"]: x["_score"] for x in r.search(
        df, c.match("text", "common rare"), scored=True).collect()}
    assert s[1] > s[4] > 0 and s[1] > s[3] > 0 and set(s) == {1, 2, 3, 4}
    # a filter changes which rows come back, never their scores
    narrow = {x["id"]: x["_score"] for x in r.search(df, c.bool_(
        must=[c.match("text", "common rare")], filter=[c.term("id", 1)]), scored=True).collect()}
    assert narrow == {1: pytest.approx(s[1])}
    stats = r.corpus_stats(df, c.match("text", "common rare"))
    again = r.search(df, c.match("text", "common rare"), scored=True, stats=stats)
    assert {x["id"]: x["_score"] for x in again.collect()} == s


@pytest.mark.parametrize("block", [2_000, 3])
def test_batch_search_equals_single_searches(spark, sf, block):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    queries = spark.read.parquet(f"{sf}/benchmark.parquet").limit(7)
    got = r.batch_search(docs, "text", "doc_id", queries, "item_id", "text", 4, block=block)
    rows = {}
    for x in got.collect():
        rows.setdefault(x["item_id"], {})[x["rank"]] = (x["doc_id"], round(x["_score"], 6))
    for q in queries.limit(2).collect():
        hits = r.search(docs, c.match("text", q["text"]), scored=True).withColumn(
            "_score", F.round("_score", 9))
        want = [(x["doc_id"], round(x["_score"], 6)) for x in r.top_hits(hits, 4, "doc_id").collect()]
        assert [rows[q["item_id"]][i] for i in sorted(rows[q["item_id"]])] == want


def test_batch_search_is_the_same_in_small_blocks(spark, sf, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(300).coalesce(1)
    queries = spark.read.parquet(f"{sf}/benchmark.parquet").limit(20)

    def hits():
        got = r.batch_search(docs, "text", "doc_id", queries, "item_id", "text", 3)
        return sorted((x["item_id"], x["rank"], x["doc_id"], x["_score"]) for x in got.collect())

    want = hits()
    monkeypatch.setattr(r, "SLICE_ROWS", 70)
    monkeypatch.setattr(r, "SCORE_PAIRS", 500)
    assert hits() == want and len(want) == 60


def test_knn_brute_force_blocks_and_recall(spark, sf):
    emb = spark.read.parquet(f"{sf}/embeddings.parquet")
    queries = emb.where("vec_id < 7").select(F.col("vec_id").alias("q"), "embedding")
    for sim in ("cosine", "dot_product", "l2"):
        whole = v.knn_batch(emb, "embedding", "vec_id", queries, "q", "embedding", 5, sim)
        parts = v.knn_batch(emb, "embedding", "vec_id", queries, "q", "embedding", 5, sim, block=2)
        key = lambda df: sorted((x["q"], x["rank"], x["vec_id"]) for x in df.collect())
        assert key(whole) == key(parts)
        q0 = queries.where("q = 3").first()["embedding"]
        one = [x["vec_id"] for x in v.knn(emb, "embedding", q0, 5, "vec_id", sim).collect()]
        assert one == [i for q, _, i in key(whole) if q == 3]
    signed = v.signature(emb, "embedding", 64).select("vec_id", "signature")
    hits = []
    for q in queries.collect():
        exact = {x["vec_id"] for x in v.knn(emb, "embedding", q["embedding"], 10, "vec_id").collect()}
        near = {x["vec_id"] for x in v.knn_candidates(
            signed, emb, "embedding", q["embedding"], 10, 150, "vec_id").collect()}
        hits.append(len(exact & near) / 10)
    assert statistics.mean(hits) >= 0.9
    everything = v.knn_candidates(signed, emb, "embedding", q0, 10, 10_000, "vec_id")
    assert [x["vec_id"] for x in everything.collect()] == [
        x["vec_id"] for x in v.knn(emb, "embedding", q0, 10, "vec_id").collect()]


def test_vectors_of_other_sizes_are_never_hits(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0]), (3, None), (4, [0.0, 1.0])],
                               "id int, x array<float>")
    assert [y["id"] for y in v.knn(df, "x", [1.0, 0.1], 9, "id").collect()] == [1, 4]


def test_hours_where_clocks_change(spark):
    df = spark.sql("""SELECT explode(array(timestamp_ntz '2024-10-27 00:30:00',
        timestamp_ntz '2024-10-27 01:30:00', timestamp_ntz '2024-03-31 00:10:00',
        timestamp_ntz '2024-03-31 02:10:00')) AS t""")

    def keys(**how):
        rows = f.date_histogram(df, "t", time_zone="Europe/Paris", **how).collect()
        return {str(r["key"]): r["doc_count"] for r in rows}

    hours = keys(calendar_interval="hour", min_doc_count=1)
    assert hours["2024-10-27 00:00:00"] == hours["2024-10-27 01:00:00"] == 1
    filled = f.date_histogram(df.where("t < '2024-04-01'"), "t", calendar_interval="hour",
                              time_zone="Europe/Paris").collect()
    assert [(str(r["key"])[11:16], r["key_as_string"][11:16], r["doc_count"]) for r in sorted(
        filled, key=lambda r: r["key"])] == [
        ("00:00", "01:00", 1), ("01:00", "03:00", 0), ("02:00", "04:00", 1)]
    assert keys(fixed_interval="1h", min_doc_count=1) == hours
    days = keys(fixed_interval="1d", min_doc_count=1)
    assert days == {"2024-03-30 23:00:00": 2, "2024-10-26 22:00:00": 2}


def test_ranks_and_deep_pages_over_several_keys(spark):
    rows = [(i, i % 7 if i % 5 else None, "ab"[i % 2]) for i in range(12_000)]
    df = spark.createDataFrame(rows, "id long, n long, s string").repartition(6)
    sort = [("n", "desc"), "s"]
    want = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[2], r[0]))
    got = {r["id"]: r["rank"] for r in p.ranked(df, sort, "id").collect()}
    assert got == {r[0]: k + 1 for k, r in enumerate(want)}
    last = want[9_699]
    after = p.page_after(df, sort, "id", (last[1], last[2], last[0]), 20).collect()
    assert [r["id"] for r in after] == [r[0] for r in want[9_700:9_720]]
    last = want[10]
    after = p.page_after(df, sort, "id", (last[1], last[2], last[0]), 20).collect()
    assert [r["id"] for r in after] == [r[0] for r in want[11:31]]


# ---- running totals, range tables, mergeable summaries


def test_a_table_of_ranges_against_brute_force(spark):
    rng = random.Random(3)
    values = [(rng.choice([None, 7.0, 7.0, round(rng.uniform(0, 20), 1)]), rng.randint(1, 9)) for _ in range(3000)]
    edges = [None, 7.0, *[round(rng.uniform(-2, 22), 1) for _ in range(30)]]
    table = [(i, rng.choice(edges), rng.choice(edges), "own") for i in range(400)]
    table += [table[0], (None, None, None, None)]
    df = spark.createDataFrame(values, "v double, w long").repartition(5)
    ranges = spark.createDataFrame(table, "key int, `from` double, `to` double, note string").repartition(3)
    out = range_table(df, "v", ranges, sums=["w"])

    def want(low, high):
        inside = [w for v, w in values if v is not None and (low is None or v >= low) and (
            high is None or v < high)]
        return len(inside), sum(inside)

    got = sorted(map(tuple, out.collect()), key=str)
    assert got == sorted([(*r, *want(r[1], r[2])) for r in table], key=str)
    assert "CartesianProduct" not in plan(out)
    none = range_table(df.limit(0), "v", ranges, sums=["w"])
    assert {(r["doc_count"], r["sum_w"]) for r in none.collect()} == {(0, 0)}
    assert range_table(df, "v", ranges.limit(0)).collect() == []


def test_a_hundred_thousand_overlapping_ranges(spark):
    """All contain the middle, so joining rows with ranges would make two billion pairs."""
    df = spark.range(20_000).select(F.col("id").cast("double").alias("v"))
    ranges = spark.range(100_000).select("id", (10_000 - F.col("id") / 10).alias("from"),
                                         (10_001 + F.col("id") / 10).alias("to"))
    out = range_table(df, "v", ranges)
    assert "NestedLoopJoin BuildRight, Inner, (" not in plan(out)
    wrong = out.where(F.col("doc_count") != F.least(F.lit(20_000), F.ceil("to")) - F.greatest(
        F.lit(0), F.ceil("from"))).count()
    assert wrong == 0 and out.count() == 100_000


def test_log_linear_buckets_are_within_their_error_and_merge(spark):
    rng = random.Random(8)
    values = [rng.choice([0.0, 1.0, -2.5, rng.lognormvariate(0, 6), -rng.lognormvariate(0, 6)]) for _ in range(4000)]
    rows = [(i % 7, v) for i, v in enumerate(values)] + [(1, None), (2, float("nan"))]
    df = spark.createDataFrame(rows, "day int, v double").repartition(4)
    percents = [0, 1, 25, 50, 77.7, 99, 100]
    daily = s.hdr_histogram(df, "v", ["day"], digits=3)
    merged = {r["percent"]: r["value"] for r in s.hdr_percentiles(s.hdr_merge(daily), percents).collect()}
    whole = {r["percent"]: r["value"] for r in s.hdr_percentiles(s.hdr_histogram(df, "v"), percents).collect()}
    assert merged == whole and len(whole) == len(percents)
    ordered = sorted(values)
    for q, found in whole.items():
        exact = ordered[max(0, math.ceil(q / 100 * len(ordered)) - 1)]
        assert abs(found - exact) <= 0.5e-3 * abs(exact)
    per_day = s.hdr_percentiles(daily, [50], ["day"]).collect()
    assert {r["day"] for r in per_day} == set(range(7))


def test_digests_merge_within_their_rank_error(spark):
    rng = random.Random(9)
    values = [rng.choice([5.0, rng.gauss(0, 1), rng.lognormvariate(0, 3)]) for _ in range(30_000)]
    rows = [(None if i % 3 else i % 5, v) for i, v in enumerate(values)] + [(1, None), (1, float("nan"))]
    df = spark.createDataFrame(rows, "day int, v double").repartition(6)
    daily = s.tdigest(df, "v", ["day"])
    assert daily.count() == 6
    assert all(len(r["means"]) <= s.COMPRESSION / 2 + 2 for r in daily.collect())
    ordered = sorted(values)
    for digest in (s.tdigest(df, "v"), s.tdigest_merge(daily)):
        for r in s.tdigest_percentiles(digest, [0, 0.1, 5, 50, 90, 99.9, 100]).collect():
            q = r["percent"] / 100
            slack = 4 * math.pi * math.sqrt(q * (1 - q)) / s.COMPRESSION * len(values) + 2
            low, high = bisect.bisect_left(ordered, r["value"]), bisect.bisect_right(ordered, r["value"])
            assert low - slack <= q * len(values) <= high + slack
    assert s.tdigest_percentiles(s.tdigest(df.limit(0), "v"), [50]).collect() == []

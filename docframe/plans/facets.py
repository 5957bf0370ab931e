"""Metric and bucket facets."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..operators import clauses as c
from ..operators import facets as f
from ..operators import sketches as sk
from ..operators.running import range_table, running
from ..sources.lineage import stored
from ..sources.tables import read
from .registry import query


def _lines(spark, sf):
    return read(spark, sf, "lineitem")


@query("agg_avg", "SELECT round(avg(l_extendedprice), 6) AS avg_price FROM lineitem")
def agg_avg(spark, sf):
    return f.metrics(_lines(spark, sf), avg_price=F.round(f.avg("l_extendedprice"), 6))


@query("agg_sum", "SELECT round(sum(l_quantity), 2) AS sum_quantity FROM lineitem")
def agg_sum(spark, sf):
    return f.metrics(_lines(spark, sf), sum_quantity=F.round(f.sum_("l_quantity"), 2))


@query("agg_min", "SELECT min(l_extendedprice) AS lo, min(l_shipdate) AS first FROM lineitem")
def agg_min(spark, sf):
    return f.metrics(_lines(spark, sf), lo=f.min_("l_extendedprice"), first=f.min_("l_shipdate"))


@query("agg_max", "SELECT max(l_extendedprice) AS hi, max(l_shipdate) AS last FROM lineitem")
def agg_max(spark, sf):
    return f.metrics(_lines(spark, sf), hi=f.max_("l_extendedprice"), last=f.max_("l_shipdate"))


@query("agg_value_count", """
    SELECT count(nullif(event_type, 'click')) AS kinds,
           sum(len(string_split(props, ' ')))::BIGINT AS words FROM events""")
def agg_value_count(spark, sf):
    rows = read(spark, sf, "events").select(
        F.nullif("event_type", F.lit("click")).alias("kind"), F.split("props", " ").alias("words"))
    return f.metrics(rows, kinds=f.value_count("kind"), words=f.value_count("words", is_list=True))


@query("agg_stats", """
    SELECT count(o_totalprice) AS count, min(o_totalprice) AS min, max(o_totalprice) AS max,
           round(avg(o_totalprice), 6) AS avg, round(sum(o_totalprice), 2) AS sum FROM orders""")
def agg_stats(spark, sf):
    out = read(spark, sf, "orders").agg(*f.stats("o_totalprice"))
    return out.withColumns({"avg": F.round("avg", 6), "sum": F.round("sum", 2)})


@query("agg_extended_stats", """
    SELECT count(value) AS count, min(value) AS min, max(value) AS max,
           round(avg(value), 6) AS avg, round(sum(value), 4) AS sum,
           round(sum(value * value), 3) AS sum_of_squares,
           round(var_pop(value), 6) AS variance, round(var_pop(value), 6) AS variance_population,
           round(var_samp(value), 6) AS variance_sampling,
           round(stddev_pop(value), 6) AS std_deviation,
           round(stddev_pop(value), 6) AS std_deviation_population,
           round(stddev_samp(value), 6) AS std_deviation_sampling,
           round(avg(value) + 3 * stddev_pop(value), 6) AS bound_upper,
           round(avg(value) - 3 * stddev_pop(value), 6) AS bound_lower
    FROM events""")
def agg_extended_stats(spark, sf):
    out = read(spark, sf, "events").agg(*f.extended_stats("value", sigma=3))
    digits = {"sum": 4, "sum_of_squares": 3}
    return out.withColumns({
        n: F.round(n, digits.get(n, 6)) for n in out.columns if n not in ("count", "min", "max")})


@query("agg_cardinality_exact", """
    SELECT count(DISTINCT l_partkey) AS parts, count(DISTINCT l_orderkey) AS orders
    FROM lineitem""")
def agg_cardinality_exact(spark, sf):
    return f.metrics(_lines(spark, sf), parts=f.cardinality("l_partkey"),
                     orders=f.cardinality("l_orderkey"))


@query("agg_cardinality", """
    SELECT count(DISTINCT l_partkey) AS parts, true AS parts_close,
           count(DISTINCT l_orderkey) AS orders, true AS orders_close FROM lineitem""")
def agg_cardinality(spark, sf):
    """The sketches beside the exact counts: close means within three standard errors."""
    both = f.metrics(
        _lines(spark, sf), parts=f.cardinality("l_partkey"), orders=f.cardinality("l_orderkey"),
        a=f.approx_cardinality("l_partkey"),
        b=f.approx_cardinality("l_orderkey", precision_threshold=40000))

    def close(approx: str, exact: str, threshold: int):
        error = 3 * min(0.05, max(0.005, 1.04 / threshold ** 0.5))
        return F.abs(F.col(approx) - F.col(exact)) <= F.ceil(F.lit(error) * F.col(exact))

    return both.select("parts", close("a", "parts", f.PRECISION).alias("parts_close"),
                       "orders", close("b", "orders", 40000).alias("orders_close"))


@query("agg_percentiles", """
    SELECT unnest([1.0, 5.0, 25.0, 50.0, 75.0, 95.0, 99.0])::DOUBLE AS percent,
           unnest([round(x, 6) FOR x IN quantile_cont(l_extendedprice,
                  [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99])]) AS value
    FROM lineitem""")
def agg_percentiles(spark, sf):
    out = f.percentiles(_lines(spark, sf), "l_extendedprice")
    return out.withColumn("value", F.round("value", 6))


@query("agg_percentiles_approx", """
    SELECT unnest([1.0, 5.0, 25.0, 50.0, 75.0, 95.0, 99.0])::DOUBLE AS percent, true AS close""")
def agg_percentiles_approx(spark, sf):
    """Sketched percentiles, and whether each one's rank in the data is within the accuracy."""
    lines, accuracy = _lines(spark, sf), 20_000
    rows = f.approx_percentiles(lines, "l_extendedprice", accuracy=accuracy)
    found = rows.agg(F.array_sort(F.collect_list(F.struct("percent", "value"))).alias("l")).scalar()
    v = F.col("l_extendedprice")
    at = [F.get(found, F.lit(i))["value"] for i in range(len(f.PERCENTS))]
    counts = lines.agg(
        F.count(v).alias("n"), *[F.count(F.when(v < x, 1)).alias(f"below{i}") for i, x in enumerate(at)],
        *[F.count(F.when(v <= x, 1)).alias(f"upto{i}") for i, x in enumerate(at)])
    slack = F.col("n") / accuracy + 1
    return counts.select(F.inline(F.array(*[F.struct(
        F.lit(float(p)).alias("percent"),
        ((F.col(f"below{i}") <= F.col("n") * p / 100 + slack)
         & (F.col(f"upto{i}") >= F.col("n") * p / 100 - slack)).alias("close"))
        for i, p in enumerate(f.PERCENTS)])))


PERCENTS_SQL = "[0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]"
PERCENT_ROWS = "unnest([1.0, 5.0, 25.0, 50.0, 75.0, 95.0, 99.0])::DOUBLE AS percent"


@query("agg_percentiles_hdr", f"""
    SELECT o_orderpriority AS priority, {PERCENT_ROWS},
           unnest([round(x, 2) FOR x IN quantile_disc(o_totalprice, {PERCENTS_SQL})]) AS exact, true AS close
    FROM orders GROUP BY 1""")
def agg_percentiles_hdr(spark, sf):
    """Histograms per day of order, merged into priorities: every percentile is within half a thousandth."""
    orders, digits = read(spark, sf, "orders"), 3
    daily = sk.hdr_histogram(orders, "o_totalprice", ["o_orderdate", "o_orderpriority"], digits)
    found = sk.hdr_percentiles(sk.hdr_merge(daily, ["o_orderpriority"]), f.PERCENTS, ["o_orderpriority"])
    exact = _exact_per_priority(orders)
    error = F.abs(F.col("value") - F.col("exact")) / F.abs(F.col("exact"))
    return exact.join(found, ["o_orderpriority", "percent"]).select(
        F.col("o_orderpriority").alias("priority"), "percent", F.round("exact", 2).alias("exact"),
        (error <= 0.5 * 10 ** -digits).alias("close"))


def _exact_per_priority(orders):
    """The values of rank ceil(percent / 100 · n), from the number of rows below each."""
    cells = orders.groupBy("o_orderpriority", "o_totalprice").agg(F.count(F.lit(1)).alias("n"))
    placed = running(cells, ["o_orderpriority", "o_totalprice"], {"n": "below"})
    of = cells.groupBy("o_orderpriority").agg(F.sum("n").alias("all"))
    starts = placed.groupBy("o_orderpriority").agg(F.min("below").alias("start"))
    wanted = of.join(starts, "o_orderpriority").withColumn("percent", F.explode(F.array(*[
        F.lit(p) for p in f.PERCENTS])))
    rank = F.col("start") + F.ceil(F.col("percent") / 100 * F.col("all"))
    return placed.join(wanted, "o_orderpriority").where(
        (rank > F.col("below")) & (rank <= F.col("below") + F.col("n"))).select(
        "o_orderpriority", "percent", F.col("o_totalprice").alias("exact"))


@query("agg_percentiles_tdigest", f"""
    SELECT percent, n, true AS close
    FROM (SELECT count(*) AS n FROM orders), (SELECT {PERCENT_ROWS})""")
def agg_percentiles_tdigest(spark, sf):
    """Digests per day of order, merged: each value's rank is within 4π·sqrt(q(1-q)) / compression."""
    orders = read(spark, sf, "orders")
    daily = sk.tdigest(orders, "o_totalprice", ["o_orderdate"])
    rows = sk.tdigest_percentiles(sk.tdigest_merge(daily), f.PERCENTS)
    found = rows.agg(F.array_sort(F.collect_list(F.struct("percent", "value"))).alias("l")).scalar()
    v, cells = F.col("o_totalprice"), []
    for i, p in enumerate(f.PERCENTS):
        x = F.get(found, F.lit(i))["value"]
        cells += [F.count(F.when(v < x, 1)).alias(f"below{i}"), F.count(F.when(v <= x, 1)).alias(f"upto{i}")]
    counts = orders.agg(F.count(v).alias("n"), *cells)

    def close(i: int, q: float):
        slack = F.col("n") * (4 * math.pi * math.sqrt(q * (1 - q)) / sk.COMPRESSION) + 1
        return (F.col(f"below{i}") <= F.col("n") * q + slack) & (F.col(f"upto{i}") >= F.col("n") * q - slack)

    return counts.select(F.inline(F.array(*[F.struct(
        F.lit(p).alias("percent"), F.col("n"), close(i, p / 100).alias("close"))
        for i, p in enumerate(f.PERCENTS)])))


@query("agg_rollup", """
    SELECT year(o_orderdate)::INT AS year, count(*) AS n, count(DISTINCT o_custkey) AS customers,
           true AS customers_close, true AS median_close
    FROM orders GROUP BY 1""")
def agg_rollup(spark, sf):
    """Sketches per day, stored, and merged into years: distinct customers within three standard
    errors, the median's rank within two hundredths."""
    orders = read(spark, sf, "orders")
    daily = stored(orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), f.distinct_sketch("o_custkey").alias("who"),
        f.percentile_sketch("o_totalprice").alias("price")))
    yearly = sk.roll_up(daily.withColumn("year", F.year("day")), ["year"], ["price"], ["who"], ["n"]).select(
        "year", "n", sk.sketched_distinct("who").alias("who"), sk.sketched_percentile("price", 50).alias("median"))
    rows = orders.select(F.year("o_orderdate").alias("year"), "o_custkey", "o_totalprice").join(
        yearly.select("year", "median"), "year")
    exact = rows.groupBy("year").agg(
        F.count_distinct("o_custkey").alias("customers"),
        F.avg((F.col("o_totalprice") <= F.col("median")).cast("int")).alias("share"))
    # the sketch has 2^12 registers
    return yearly.join(exact, "year").select(
        "year", "n", "customers", (F.abs(F.col("who") - F.col("customers")) <= F.ceil(
            3 * 1.04 / 64 * F.col("customers"))).alias("customers_close"),
        (F.abs(F.col("share") - 0.5) <= 0.02 + 1 / F.col("n")).alias("median_close"))


@query("agg_range_table", """
    WITH r AS (SELECT o_orderkey, o_totalprice * 0.3 AS low, o_totalprice * 0.3 + o_custkey AS high
               FROM orders),
    v AS (SELECT l_extendedprice AS v, count(*) AS n, sum(l_quantity::BIGINT)::BIGINT AS q FROM lineitem GROUP BY 1),
    e AS (SELECT v, n, q, 1 AS kind FROM v UNION ALL SELECT low, 0, 0, 0 FROM r UNION ALL SELECT high, 0, 0, 0 FROM r),
    p AS (SELECT v, kind, sum(n) OVER w AS n, sum(q) OVER w AS q FROM e
          WINDOW w AS (ORDER BY v, kind RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
    d AS (SELECT DISTINCT v, n, q FROM p WHERE kind = 0)
    SELECT o_orderkey AS key, (b.n - a.n)::BIGINT AS doc_count, (b.q - a.q)::BIGINT AS quantity
    FROM r JOIN d a ON r.low = a.v JOIN d b ON r.high = b.v""")
def agg_range_table(spark, sf):
    """A range of prices per order, all of them overlapping: the lines in it and their quantity."""
    orders = read(spark, sf, "orders").select(
        F.col("o_orderkey").alias("key"), (F.col("o_totalprice") * 0.3).alias("from"),
        (F.col("o_totalprice") * 0.3 + F.col("o_custkey")).alias("to"))
    lines = _lines(spark, sf).withColumn("q", F.col("l_quantity").cast("long"))
    return range_table(lines, "l_extendedprice", orders, sums=["q"]).select(
        "key", "doc_count", F.col("sum_q").alias("quantity"))


@query("agg_terms", """
    SELECT l_partkey AS key, count(*) AS doc_count FROM lineitem
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def agg_terms(spark, sf):
    return f.terms(_lines(spark, sf), "l_partkey")


@query("agg_terms_by_key", """
    SELECT p_brand AS key, count(*) AS doc_count FROM part GROUP BY 1 ORDER BY 1 DESC LIMIT 7""")
def agg_terms_by_key(spark, sf):
    return f.terms(read(spark, sf, "part"), "p_brand", size=7, order={"_key": "desc"})


@query("agg_terms_array", r"""
    SELECT key, count(*) AS doc_count FROM (
        SELECT unnest(list_distinct(regexp_split_to_array(url, '[/?&=.#:]+'))) AS key FROM pages)
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 25""")
def agg_terms_array(spark, sf):
    rows = read(spark, sf, "pages").select(F.split("url", "[/?&=.#:]+").alias("parts"))
    return f.terms(rows, "parts", size=25, is_list=True)


@query("agg_terms_with_metrics", """
    SELECT o_orderpriority AS key, count(*) AS doc_count, round(avg(o_totalprice), 6) AS avg_price,
           max(o_orderdate) AS latest, count(DISTINCT o_custkey) AS customers
    FROM orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def agg_terms_with_metrics(spark, sf):
    return f.terms(read(spark, sf, "orders"), "o_orderpriority", metrics=[
        F.round(f.avg("o_totalprice"), 6).alias("avg_price"),
        f.max_("o_orderdate").alias("latest"), f.cardinality("o_custkey").alias("customers")])


@query("agg_histogram", """
    SELECT floor(l_extendedprice / 2500) * 2500.0::DOUBLE AS key, count(*) AS doc_count
    FROM lineitem GROUP BY 1 HAVING count(*) >= 20""")
def agg_histogram(spark, sf):
    return f.histogram(_lines(spark, sf), "l_extendedprice", 2500, min_doc_count=20)


@query("agg_histogram_gapfill", """
    WITH b AS (SELECT floor(value / 4)::BIGINT AS g, count(*) AS n FROM events GROUP BY 1),
    g AS (SELECT unnest(generate_series(least(min(g), -5), greatest(max(g), 200))) AS g FROM b)
    SELECT g * 4.0::DOUBLE AS key, coalesce(n, 0) AS doc_count FROM g LEFT JOIN b USING (g)""")
def agg_histogram_gapfill(spark, sf):
    return f.histogram(read(spark, sf, "events"), "value", 4, extended_bounds=(-20, 800))


def _string_key(out):
    return out.select("key", "doc_count")


@query("agg_date_hist_calendar", """
    WITH b AS (SELECT date_trunc('month', o_orderdate)::TIMESTAMP AS key, count(*) AS n
               FROM orders GROUP BY 1)
    SELECT key, n AS doc_count FROM b
    UNION ALL
    SELECT date_trunc('week', ts)::TIMESTAMP, count(*) FROM events GROUP BY 1""")
def agg_date_hist_calendar(spark, sf):
    monthly = f.date_histogram(read(spark, sf, "orders"), "o_orderdate",
                               calendar_interval="month", min_doc_count=1)
    weekly = f.date_histogram(read(spark, sf, "events"), "ts",
                              calendar_interval="1w", min_doc_count=1)
    return _string_key(monthly).unionByName(_string_key(weekly))


@query("agg_date_hist_fixed", """
    SELECT time_bucket(INTERVAL 5 HOUR, ts, TIMESTAMP '1970-01-01') AS key, count(*) AS doc_count
    FROM events GROUP BY 1""")
def agg_date_hist_fixed(spark, sf):
    return _string_key(f.date_histogram(
        read(spark, sf, "events"), "ts", fixed_interval="5h", min_doc_count=1))


@query("agg_date_hist_tz", """
    SELECT timezone('UTC', timezone('Europe/Paris', d)) AS key, count(*) AS doc_count,
           round(sum(o_totalprice), 2) AS total
    FROM (SELECT date_trunc('day', timezone('Europe/Paris', timezone('UTC', o_orderdate)))
                 ::TIMESTAMP AS d, o_totalprice FROM orders) GROUP BY 1""")
def agg_date_hist_tz(spark, sf):
    return f.date_histogram(
        read(spark, sf, "orders"), "o_orderdate", calendar_interval="day",
        time_zone="Europe/Paris", min_doc_count=1,
        metrics=[F.round(F.sum("o_totalprice"), 2).alias("total")],
    ).select("key", "doc_count", "total")


@query("agg_date_hist_offset", """
    SELECT date_trunc('day', ts - INTERVAL 6 HOUR) + INTERVAL 6 HOUR AS key, 'day' AS kind,
           count(*) AS doc_count FROM events GROUP BY 1
    UNION ALL
    SELECT time_bucket(INTERVAL 12 HOUR, ts + INTERVAL 1 HOUR, TIMESTAMP '1970-01-01')
           - INTERVAL 1 HOUR, 'half', count(*) FROM events GROUP BY 1""")
def agg_date_hist_offset(spark, sf):
    events = read(spark, sf, "events")
    day = f.date_histogram(events, "ts", calendar_interval="1d", offset="+6h", min_doc_count=1)
    half = f.date_histogram(events, "ts", fixed_interval="12h", offset="-1h", min_doc_count=1)
    return _string_key(day).withColumn("kind", F.lit("day")).unionByName(
        _string_key(half).withColumn("kind", F.lit("half")))


@query("agg_date_hist_gapfill", """
    WITH b AS (SELECT date_trunc('minute', ts) AS k, count(*) AS n FROM events GROUP BY 1),
    g AS (SELECT unnest(generate_series(least(min(k), TIMESTAMP '2023-12-31'),
                                        greatest(max(k), TIMESTAMP '2024-02-01'),
                                        INTERVAL 1 MINUTE)) AS k FROM b)
    SELECT k AS key, coalesce(n, 0) AS doc_count FROM g LEFT JOIN b USING (k)""")
def agg_date_hist_gapfill(spark, sf):
    return _string_key(f.date_histogram(
        read(spark, sf, "events"), "ts", calendar_interval="minute",
        extended_bounds=("2023-12-31", "2024-02-01")))


@query("agg_date_hist_format", """
    SELECT strftime(date_trunc('quarter', coalesce(nullif(o_orderdate, TIMESTAMP '1997-01-01'),
                    TIMESTAMP '1990-02-02')), '%d.%m.%Y') AS key_as_string,
           count(*) AS doc_count FROM orders GROUP BY 1""")
def agg_date_hist_format(spark, sf):
    rows = read(spark, sf, "orders").select(
        F.nullif("o_orderdate", F.lit("1997-01-01 00:00:00").cast("timestamp_ntz")).alias("d"))
    return f.date_histogram(rows, "d", calendar_interval="quarter", format="dd.MM.yyyy",
                            min_doc_count=1, missing="1990-02-02 00:00:00",
                            ).select("key_as_string", "doc_count")


@query("agg_range", """
    SELECT '*-20000.0' AS key, NULL::DOUBLE AS "from", 20000.0::DOUBLE AS "to",
           count(*) FILTER (l_extendedprice < 20000) AS doc_count FROM lineitem
    UNION ALL SELECT '10000.0-60000.0', 10000, 60000,
           count(*) FILTER (l_extendedprice >= 10000 AND l_extendedprice < 60000) FROM lineitem
    UNION ALL SELECT '60000.0-*', 60000, NULL,
           count(*) FILTER (l_extendedprice >= 60000) FROM lineitem
    UNION ALL SELECT '1.0E9-*', 1e9, NULL,
           count(*) FILTER (l_extendedprice >= 1e9) FROM lineitem""".replace("1.0E9", "1000000000.0"))
def agg_range(spark, sf):
    return f.ranges(_lines(spark, sf), "l_extendedprice", [
        {"to": 20000}, {"from": 10000, "to": 60000}, {"from": 60000}, {"from": 1e9}])


@query("agg_date_range", """
    SELECT '*-1995-01' AS key, NULL::TIMESTAMP AS "from", TIMESTAMP '1995-01-01' AS "to",
           NULL AS from_as_string, '1995-01' AS to_as_string,
           count(*) FILTER (o_orderdate < TIMESTAMP '1995-01-01') AS doc_count FROM orders
    UNION ALL SELECT '1995-01-1997-06', TIMESTAMP '1995-01-01', TIMESTAMP '1997-06-01',
           '1995-01', '1997-06', count(*) FILTER (o_orderdate >= TIMESTAMP '1995-01-01'
                                  AND o_orderdate < TIMESTAMP '1997-06-01') FROM orders
    UNION ALL SELECT '1998-07-*', TIMESTAMP '1998-07-01', NULL, '1998-07', NULL,
           count(*) FILTER (o_orderdate >= TIMESTAMP '1998-07-01') FROM orders""")
def agg_date_range(spark, sf):
    return f.date_ranges(read(spark, sf, "orders"), "o_orderdate", [
        {"to": "1995-01-01"}, {"from": "1995-01-01", "to": "1997-06-01"},
        {"from": "now-1M/M"}], now="1998-08-02 10:00:00", format="yyyy-MM")


@query("agg_keyed", """
    SELECT count(*) FILTER (o_orderstatus = 'F') AS f, count(*) FILTER (o_orderstatus = 'O') AS o,
           count(DISTINCT o_orderstatus) AS n_buckets FROM orders""")
def agg_keyed(spark, sf):
    out = f.keyed(f.terms(read(spark, sf, "orders"), "o_orderstatus"))
    b = F.col("buckets")
    return out.select(b["F"].alias("f"), b["O"].alias("o"),
                      F.size(b).cast("long").alias("n_buckets"))


@query("agg_multi", """
    SELECT round(avg(l_quantity), 6) AS avg_q, min(l_quantity) AS min_q, max(l_quantity) AS max_q,
           round(sum(l_quantity), 2) AS sum_q, count(DISTINCT l_suppkey) AS suppliers,
           round(stddev_pop(l_discount), 6) AS spread FROM lineitem""")
def agg_multi(spark, sf):
    return f.metrics(
        _lines(spark, sf), avg_q=F.round(f.avg("l_quantity"), 6), min_q=f.min_("l_quantity"),
        max_q=f.max_("l_quantity"), sum_q=F.round(f.sum_("l_quantity"), 2),
        suppliers=f.cardinality("l_suppkey"), spread=F.round(F.stddev_pop("l_discount"), 6))


@query("agg_missing", """
    SELECT round(avg(coalesce(nullif(value, 0.0), 100.0)), 6) AS filled,
           round(avg(nullif(value, 0.0)), 6) AS skipped,
           count(DISTINCT coalesce(nullif(event_type, 'view'), 'none')) AS kinds FROM events""")
def agg_missing(spark, sf):
    rows = read(spark, sf, "events").select(
        F.nullif("value", F.lit(0.0)).alias("v"),
        F.nullif("event_type", F.lit("view")).alias("kind"))
    return f.metrics(rows, filled=F.round(f.avg("v", missing=100.0), 6),
                     skipped=F.round(f.avg("v"), 6), kinds=f.cardinality("kind", missing="none"))


@query("agg_filtered", """
    SELECT count(*) AS n, round(sum(l_extendedprice * l_discount), 4) AS revenue FROM lineitem
    WHERE l_discount >= 0.05 AND l_discount < 0.075 AND l_quantity < 24""")
def agg_filtered(spark, sf):
    wanted = c.bool_(filter=[c.range_("l_discount", gte=0.05, lt=0.075),
                             c.range_("l_quantity", lt=24)])
    return f.metrics(_lines(spark, sf), wanted, n=F.count(F.lit(1)), revenue=F.round(
        F.sum(F.col("l_extendedprice") * F.col("l_discount")), 4))


@query("count_all", "SELECT count(*) AS count FROM lineitem")
def count_all(spark, sf):
    return f.count(_lines(spark, sf))


@query("count_query", "SELECT count(*) AS count FROM events WHERE value >= 50")
def count_query(spark, sf):
    return f.count(read(spark, sf, "events"), c.range_("value", gte=50))

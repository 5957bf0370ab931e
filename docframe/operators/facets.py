"""Facets: metrics in one pass, and bucket facets as grouped counts.

Missing values are skipped unless ``missing`` replaces them first; list fields count each
distinct value once per row.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates
from ..functions.text import col
from .clauses import Clause
from .running import running

# Defaults of the facet parameters.
PERCENTS = (1.0, 5.0, 25.0, 50.0, 75.0, 95.0, 99.0)
TERMS_SIZE = 10
SIGMA = 2.0
PRECISION = 3000


def _value(field, missing=None) -> Column:
    c = col(field)
    return c if missing is None else F.coalesce(c, F.lit(missing))


def filtered(df: DataFrame, query: Clause | None) -> DataFrame:
    return df if query is None else df.where(query.pred)


# ---- metrics: Columns for a single agg() ---------------------------------------------


def avg(field, missing=None) -> Column:
    return F.avg(_value(field, missing))


def sum_(field, missing=None) -> Column:
    return F.sum(_value(field, missing).cast("double"))


def min_(field, missing=None) -> Column:
    return F.min(_value(field, missing))


def max_(field, missing=None) -> Column:
    return F.max(_value(field, missing))


def value_count(field, is_list: bool = False) -> Column:
    """Values, not rows: the elements of a list count one by one."""
    c = col(field)
    return F.coalesce(F.sum(F.size(F.array_compact(c))), F.lit(0)) if is_list else F.count(c)


def cardinality(field, missing=None) -> Column:
    return F.count_distinct(_value(field, missing))


def approx_cardinality(field, precision_threshold: int = PRECISION, missing=None) -> Column:
    """HyperLogLog with its relative error set from the threshold, within [0.5%, 5%]."""
    rsd = min(0.05, max(0.005, 1.04 / precision_threshold ** 0.5))
    v = _value(field, missing)
    bits = math.ceil(math.log2((1.04 / rsd) ** 2))
    return F.hll_sketch_estimate(F.hll_sketch_agg(F.when(v.isNotNull(), F.xxhash64(v)), bits))


def stats(field, prefix: str = "", missing=None) -> list[Column]:
    v = _value(field, missing).cast("double")
    return [
        F.count(v).alias(prefix + "count"), F.min(v).alias(prefix + "min"),
        F.max(v).alias(prefix + "max"), F.avg(v).alias(prefix + "avg"),
        F.sum(v).alias(prefix + "sum"),
    ]


def extended_stats(field, sigma: float = SIGMA, prefix: str = "", missing=None) -> list[Column]:
    v = _value(field, missing).cast("double")
    mean, spread = F.avg(v), F.stddev_pop(v)
    return stats(field, prefix, missing) + [
        F.sum(v * v).alias(prefix + "sum_of_squares"),
        F.var_pop(v).alias(prefix + "variance"),
        F.var_pop(v).alias(prefix + "variance_population"),
        F.var_samp(v).alias(prefix + "variance_sampling"),
        spread.alias(prefix + "std_deviation"),
        F.stddev_pop(v).alias(prefix + "std_deviation_population"),
        F.stddev_samp(v).alias(prefix + "std_deviation_sampling"),
        (mean + F.lit(sigma) * spread).alias(prefix + "bound_upper"),
        (mean - F.lit(sigma) * spread).alias(prefix + "bound_lower"),
    ]


def metrics(df: DataFrame, query: Clause | None = None, **named: Column) -> DataFrame:
    """All metrics over one scan."""
    return filtered(df, query).agg(*[c.alias(n) for n, c in named.items()])


# ---- percentiles ---------------------------------------------------------------------


def percentiles(df: DataFrame, field, percents: Sequence[float] = PERCENTS,
                missing=None, interpolate: bool = True) -> DataFrame:
    """Exact percentiles as rows (percent, value): linear between the two ranks that surround
    percent / 100 · (n - 1), or the value of rank ceil(percent / 100 · n) itself.

    Distinct values with their counts are dealt to range partitions and get the number of rows below them
    (``running``); a value is picked if a wanted rank falls on it. All of it is one plan: nothing
    comes to the driver, whatever the data, and no task holds more than its range of distinct values.
    """
    v = df.select(_value(field, missing).cast("double").alias("v")).where(F.col("v").isNotNull())
    counts = v.groupBy("v").agg(F.count(F.lit(1)).alias("c"))
    placed = running(counts, ["v"], {"c": "below"})
    n = counts.agg(F.sum("c").alias("n")).scalar()
    ranks = [F.lit(p / 100) * (n - 1) if interpolate else F.greatest(
        F.lit(0.0), F.ceil(F.lit(p / 100) * n) - 1.0) for p in percents]

    def on(r: Column) -> Column:
        return (r >= F.col("below")) & (r < F.col("below") + F.col("c"))

    met = F.array_compact(F.array(*[
        F.when(on(F.floor(r)) | on(F.ceil(r)), F.struct(F.lit(float(p)).alias("percent"), r.alias("rank")))
        for p, r in zip(percents, ranks, strict=True)]))
    low, high = F.floor("rank"), F.ceil("rank")
    picked = placed.select("*", F.inline(met)).groupBy("percent", "rank").agg(
        F.max(F.when(on(low), F.col("v"))).alias("lo"), F.max(F.when(on(high), F.col("v"))).alias("hi"))
    part = F.col("rank") - low
    return picked.select("percent", (F.col("lo") + (F.col("hi") - F.col("lo")) * part).alias("value"))


def approx_percentiles(df: DataFrame, field, percents: Sequence[float] = PERCENTS,
                       accuracy: int = 10_000, missing=None) -> DataFrame:
    """Sketched percentiles: one pass, bounded memory, rank error at most 1/accuracy."""
    cells = F.percentile_approx(
        _value(field, missing).cast("double"), [p / 100 for p in percents], accuracy
    )
    names = F.array(*[F.lit(float(p)) for p in percents])
    return df.agg(cells.alias("v")).select(
        F.explode(F.arrays_zip(names.alias("percent"), F.col("v").alias("value"))).alias("x")
    ).select("x.percent", "x.value")


def percentile_sketch(field) -> Column:
    """A mergeable sketch (KLL), to be stored per day or shard and merged later."""
    return F.kll_sketch_agg_double(col(field).cast("double"))


def distinct_sketch(field) -> Column:
    """A mergeable distinct-count sketch (HLL)."""
    return F.hll_sketch_agg(col(field))


# ---- bucket facets -------------------------------------------------------------------


def _bucket_order(order: dict[str, str] | None) -> list[Column]:
    """Default: biggest bucket first, ties by key."""
    spec = order or {"_count": "desc"}
    names = {"_count": "doc_count", "_key": "key", "_term": "key"}
    out = [
        F.col(names.get(k, k)).desc() if v == "desc" else F.col(names.get(k, k)).asc()
        for k, v in spec.items()
    ]
    return out if "_key" in spec else [*out, F.col("key").asc()]


def terms(df: DataFrame, field, size: int | None = TERMS_SIZE, order=None, is_list: bool = False,
          missing=None, metrics: Sequence[Column] = ()) -> DataFrame:
    """(key, doc_count, metrics…) for the top ``size`` values; ``size=None`` keeps them all."""
    if is_list:
        keys = df.withColumn("key", F.explode(F.array_distinct(col(field))))
    else:
        keys = df.withColumn("key", _value(field, missing))
    buckets = keys.where(F.col("key").isNotNull()).groupBy("key").agg(
        F.count(F.lit(1)).alias("doc_count"), *metrics
    )
    return buckets if size is None else buckets.orderBy(*_bucket_order(order)).limit(size)


def _steps(bounds: DataFrame) -> DataFrame:
    """Rows 0..n for a one-row frame with a column ``n``, built in two bounded explosions."""
    block = 10_000
    return (
        bounds.withColumn("b", F.explode(F.sequence(F.lit(0), F.floor(F.col("n") / block))))
        .repartition("b")
        .withColumn("i", F.explode(F.sequence(
            F.col("b") * block, F.least(F.col("n"), F.col("b") * block + F.lit(block - 1))
        )))
    )


def histogram(df: DataFrame, field, interval: float, min_doc_count: int = 0,
              extended_bounds: tuple | None = None, missing=None,
              metrics: Sequence[Column] = ()) -> DataFrame:
    """(key, doc_count): key = floor(v / interval) · interval.

    ``min_doc_count=0`` also returns the empty buckets across the data and the bounds.
    """
    step = F.lit(float(interval))
    grid = F.floor(_value(field, missing).cast("double") / step).cast("long")
    buckets = (
        df.withColumn("_g", grid).where(F.col("_g").isNotNull())
        .groupBy("_g").agg(F.count(F.lit(1)).alias("doc_count"), *metrics)
    )
    if min_doc_count == 0:
        low, high = F.min("_g"), F.max("_g")
        if extended_bounds is not None:
            low = F.least(low, F.floor(F.lit(float(extended_bounds[0])) / step).cast("long"))
            high = F.greatest(high, F.floor(F.lit(float(extended_bounds[1])) / step).cast("long"))
        bounds = buckets.agg(low.alias("lo"), high.alias("hi")).withColumn(
            "n", F.col("hi") - F.col("lo")
        ).where(F.col("n").isNotNull())
        keys = _steps(bounds).select((F.col("lo") + F.col("i")).alias("_g"))
        buckets = keys.join(buckets, "_g", "left").withColumn(
            "doc_count", F.coalesce("doc_count", F.lit(0))
        )
    else:
        buckets = buckets.where(F.col("doc_count") >= min_doc_count)
    rest = [c for c in buckets.columns if c not in ("_g", "doc_count")]
    return buckets.select((F.col("_g") * step).alias("key"), "doc_count", *rest)


def date_histogram(
    df: DataFrame, field, calendar_interval: str | None = None, fixed_interval: str | None = None,
    format: str | None = None, time_zone: str | None = None, min_doc_count: int = 0,
    extended_bounds: tuple[str, str] | None = None, offset: str | None = None,
    missing: str | None = None, order: dict[str, str] | None = None,
    metrics: Sequence[Column] = (),
) -> DataFrame:
    """(key, key_as_string, doc_count) per calendar unit or fixed duration.

    Calendar buckets start at local midnights, weeks on Mondays and so on in ``time_zone``
    and the key is that moment in UTC; fixed buckets are multiples of the duration since the
    epoch, in local time. Buckets of an hour or less go by elapsed time where clocks change. ``min_doc_count=0`` fills the gaps across the data and the bounds.
    """
    if (calendar_interval is None) == (fixed_interval is None):
        raise ValueError("give either calendar_interval or fixed_interval")
    ts = col(field) if missing is None else F.coalesce(col(field), dates.ntz(missing))

    def bucket(t: Column) -> Column:
        if calendar_interval:
            return dates.calendar_bucket(t, calendar_interval, time_zone, offset)
        return dates.fixed_bucket(t, fixed_interval, time_zone, offset)

    buckets = (
        df.withColumn("_k", bucket(ts)).where(F.col("_k").isNotNull())
        .groupBy("_k").agg(F.count(F.lit(1)).alias("doc_count"), *metrics)
    )
    if min_doc_count == 0:
        low, high = F.min("_k"), F.max("_k")
        if extended_bounds is not None:
            low = F.least(low, bucket(dates.ntz(extended_bounds[0])))
            high = F.greatest(high, bucket(dates.ntz(extended_bounds[1])))
        ends = buckets.agg(low.alias("lo"), high.alias("hi")).where(F.col("lo").isNotNull())
        buckets = _date_keys(ends, calendar_interval, fixed_interval, time_zone).join(
            buckets, "_k", "left"
        ).withColumn("doc_count", F.coalesce("doc_count", F.lit(0)))
    else:
        buckets = buckets.where(F.col("doc_count") >= min_doc_count)
    key = F.col("_k")
    shown = dates.to_zone(key, time_zone) if time_zone else key
    rest = [c for c in buckets.columns if c not in ("_k", "doc_count")]
    out = buckets.select(
        key.alias("key"),
        F.date_format(shown, format or "yyyy-MM-dd'T'HH:mm:ss").alias("key_as_string"),
        "doc_count", *rest,
    )
    return out if order is None else out.orderBy(*_bucket_order(order))


def _date_keys(ends: DataFrame, calendar: str | None, fixed: str | None, zone: str | None = None
               ) -> DataFrame:
    """All bucket starts between the ends. Long buckets step in local time; a local moment
    that the clocks skip falls on the next one, so starts are made distinct."""
    if zone and not dates.is_short(calendar, fixed):
        local = ends.select(*[dates.to_zone(F.col(c), zone).alias(c) for c in ("lo", "hi")])
        keys = _date_keys(local, calendar, fixed)
        return keys.select(dates.from_zone(F.col("_k"), zone).alias("_k")).distinct()
    if fixed:
        width = dates.duration_micros(fixed)
        span = dates.epoch_micros(F.col("hi")) - dates.epoch_micros(F.col("lo"))
        rows = _steps(ends.withColumn("n", F.floor(span / F.lit(width))))
        us = dates.epoch_micros(F.col("lo")) + F.col("i") * F.lit(width)
        return rows.select(dates.from_micros(us).alias("_k"))
    unit = dates.CALENDAR[calendar]
    rows = _steps(ends.withColumn("n", F.timestamp_diff(unit, F.col("lo"), F.col("hi"))))
    return rows.select(F.timestamp_add(unit, F.col("i").cast("int"), F.col("lo")).alias("_k"))


def _range_rows(df: DataFrame, specs: list[dict], in_range: list[Column],
                shape: list[tuple[str, str]], metrics=None) -> DataFrame:
    """Counts every range in the same pass, then turns the one wide row into rows."""
    counted = df.agg(*[
        F.count(F.when(test, F.lit(1))).alias(f"c{i}") for i, test in enumerate(in_range)
    ])
    rows = F.array(*[
        F.struct(
            *[F.lit(spec.get(name)).cast(kind).alias(name) for name, kind in shape],
            F.col(f"c{i}").alias("doc_count"),
        )
        for i, spec in enumerate(specs)
    ])
    return counted.select(F.inline(rows))


def ranges(df: DataFrame, field, ranges: Sequence[dict], missing=None) -> DataFrame:
    """(key, from, to, doc_count); from inclusive, to exclusive, overlaps allowed."""
    v = _value(field, missing)

    def edge(x):
        return "*" if x is None else str(float(x))

    specs, tests = [], []
    for r in ranges:
        low, high = r.get("from"), r.get("to")
        specs.append({"key": r.get("key") or f"{edge(low)}-{edge(high)}", "from": low, "to": high})
        tests.append(_between(v, None if low is None else F.lit(low),
                              None if high is None else F.lit(high)))
    shape = [("key", "string"), ("from", "double"), ("to", "double")]
    return _range_rows(df, specs, tests, shape)


def _between(v: Column, low: Column | None, high: Column | None) -> Column:
    test = v.isNotNull()
    if low is not None:
        test = test & (v >= low)
    if high is not None:
        test = test & (v < high)
    return test


def date_ranges(df: DataFrame, field, ranges: Sequence[dict], now: str | None = None,
                format: str = "yyyy-MM-dd", time_zone: str | None = None) -> DataFrame:
    """Like ``ranges`` for dates; bounds are dates or date math, in local time of the zone."""
    v = col(field)

    def moment(x):
        if x is None:
            return None
        local = dates.date_math(x, now) if x.startswith("now") or "||" in x else dates.ntz(x)
        return dates.from_zone(local, time_zone) if time_zone and not x.startswith("now") else local

    pairs = [(moment(r.get("from")), moment(r.get("to"))) for r in ranges]
    counted = df.agg(*[
        F.count(F.when(_between(v, lo, hi), F.lit(1))).alias(f"c{i}")
        for i, (lo, hi) in enumerate(pairs)
    ])

    def shown(t):
        local = dates.to_zone(t, time_zone) if time_zone and t is not None else t
        return F.lit(None).cast("string") if t is None else F.date_format(local, format)

    rows = F.array(*[
        F.struct(
            F.concat(F.coalesce(shown(lo), F.lit("*")), F.lit("-"),
                     F.coalesce(shown(hi), F.lit("*"))).alias("key"),
            (F.lit(None) if lo is None else lo).cast("timestamp_ntz").alias("from"),
            (F.lit(None) if hi is None else hi).cast("timestamp_ntz").alias("to"),
            shown(lo).alias("from_as_string"), shown(hi).alias("to_as_string"),
            F.col(f"c{i}").alias("doc_count"),
        )
        for i, (lo, hi) in enumerate(pairs)
    ])
    return counted.select(F.inline(rows))


def keyed(buckets: DataFrame, key: str = "key", value: str = "doc_count", most: int = 10_000
          ) -> DataFrame:
    """The buckets of any facet as one map from key to value. At most ``most`` buckets go into the
    one row; more are refused, not cut: such a facet stays rows."""
    pairs = F.sort_array(F.collect_list(F.struct(F.col(key).cast("string"), F.col(value))))
    some = buckets.select(key, value).limit(most + 1).agg(pairs.alias("p"))
    refused = F.raise_error(F.lit(f"more than {most} buckets do not make a map"))
    return some.select(F.when(F.size("p") > most, refused).otherwise(
        F.map_from_entries("p")).alias("buckets"))


def count(df: DataFrame, query: Clause | None = None) -> DataFrame:
    return filtered(df, query).agg(F.count(F.lit(1)).alias("count"))

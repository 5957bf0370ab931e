"""Mergeable summaries: log-linear histograms, digests of centroids, and their roll-up.

A summary is made per key (a day, a shard), stored as rows, and merged later into coarser keys without reading
the data again.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql import types as T

from ..functions.text import col

# Fixed value: the digest's default number of centroids is about half of this.
COMPRESSION = 200
# Values of a key that a task holds before it summarises them, and keys it holds at once.
BUFFER = 1 << 16
KEYS = 1 << 12
# Digests merged by one task at a time.
FAN_IN = 256
DIGEST = "means array<double>, weights array<double>, low double, high double"


# ---- log-linear histogram ------------------------------------------------------------


def log_linear(value: Column, digits: int = 3) -> tuple[Column, Column]:
    """The bounds [from, to) of a value's bucket: each power of two is cut into equal steps, so fine that a
    bucket is at most 10^-digits of the value wide. Zero has a bucket of its own."""
    steps = math.ceil(math.log2(10 ** digits))
    size = F.pow(F.lit(2.0), F.floor(F.log2(F.abs(value))) - steps)
    start = F.floor(value / size) * size
    zero = value == 0
    return (F.when(zero, 0.0).otherwise(start), F.when(zero, 0.0).otherwise(start + size))


def hdr_histogram(df: DataFrame, field, by: Sequence[str] = (), digits: int = 3) -> DataFrame:
    """(by…, from, to, n) per bucket that holds values. The number of buckets depends on the range of
    the values, not on how many there are; NULL and NaN are skipped."""
    v = col(field).cast("double")
    low, high = log_linear(F.col("_v"), digits)
    rows = df.select(*by, v.alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    return rows.groupBy(*by, low.alias("from"), high.alias("to")).agg(F.count(F.lit(1)).alias("n"))


def hdr_merge(histograms: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Stored histograms, summed up into the keys ``by``."""
    return histograms.groupBy(*by, "from", "to").agg(F.sum("n").alias("n"))


def hdr_percentiles(histogram: DataFrame, percents: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """(by…, percent, value): the middle of the bucket that holds the value of rank ceil(percent/100 · n), so
    within half a bucket, 10^-digits / 2 of it."""
    key = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1))
    upto = F.sum("n").over(key.orderBy("from").rowsBetween(Window.unboundedPreceding, 0))
    placed = histogram.withColumns({"_upto": upto, "_all": F.sum("n").over(key)})
    wanted = F.array(*[F.lit(float(p)) for p in percents])
    rank = F.greatest(F.lit(1), F.ceil(F.col("percent") / 100 * F.col("_all")))
    return placed.withColumn("percent", F.explode(wanted)).where(
        (rank <= F.col("_upto")) & (rank > F.col("_upto") - F.col("n"))).select(
        *by, "percent", ((F.col("from") + F.col("to")) / 2).alias("value"))


# ---- digest of centroids -------------------------------------------------------------


def _compress(means, weights, compression: int):
    """At most about compression / 2 centroids of the sorted (mean, weight) pairs: neighbours share one
    if the scale function k(q) = c / 2π · asin(2q - 1) puts them into the same unit, so
    centroids are light at both ends (Dunning & Ertl 2019)."""
    import numpy as np

    by = np.argsort(means, kind="stable")
    means, weights = means[by], weights[by]
    q = (np.cumsum(weights) - weights / 2) / weights.sum()
    unit = np.floor(compression / (2 * np.pi) * (np.arcsin(2 * q - 1) + np.pi / 2))
    first = np.flatnonzero(np.concatenate([[True], np.diff(unit) != 0]))
    heavy = np.add.reduceat(weights, first)
    return np.add.reduceat(means * weights, first) / heavy, heavy


def _quantile(means, weights, low: float, high: float, shares):
    """Linear between the middles of centroids; the least and greatest value at the ends."""
    import numpy as np

    middle = np.cumsum(weights) - weights / 2
    at = np.asarray(shares) * weights.sum()
    return np.interp(at, [0, *middle, weights.sum()], [low, *means, high])


def _digest_schema(df: DataFrame, by: Sequence[str]) -> T.StructType:
    parts = T._parse_datatype_string(DIGEST).fields
    return T.StructType([*[df.schema[c] for c in by], *parts])


def tdigest(df: DataFrame, field, by: Sequence[str] = (), compression: int = COMPRESSION) -> DataFrame:
    """(by…, means, weights, low, high): one digest per key, of the values that are neither NULL nor NaN.

    Every task digests the values it reads, ``BUFFER`` at a time, and only digests are shuffled, so a key
    may own any share of the rows. Quantile q is found within about 2π·sqrt(q(1-q)) / compression of its rank."""
    rows = df.select(*by, col(field).cast("double").alias("_v")).where(
        F.col("_v").isNotNull() & ~F.isnan("_v"))
    schema = T.StructType([*_digest_schema(rows, by).fields, T.StructField("_task", T.IntegerType())])
    arrow, n = to_arrow_schema(schema), len(by)

    def digest(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        task = TaskContext.get().partitionId() // FAN_IN
        held: dict[tuple, list] = {}

        def squeezed(parts: list):
            means = np.concatenate([m for m, _ in parts])
            return _compress(means, np.concatenate([w for _, w in parts]), compression)

        def rows_out():
            columns = [[] for _ in range(n + 5)]
            for key, (parts, _, low, high) in held.items():
                means, weights = squeezed(parts)
                for out, x in zip(columns, (*key, means, weights, low, high, task), strict=True):
                    out.append(x)
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

        for batch in batches:
            if not batch.num_rows:
                continue
            values = batch.column(n).to_numpy(zero_copy_only=False)
            if n:
                table = pa.Table.from_batches([batch.select(list(range(n)))]).append_column(
                    "_at", pa.array(np.arange(batch.num_rows)))
                groups = table.group_by(table.column_names[:n]).aggregate([("_at", "list")])
                keys = zip(*[groups[c].to_pylist() for c in table.column_names[:n]], strict=True)
                places = [x.values.to_numpy() for x in groups["_at_list"]]
            else:
                keys, places = [()], [slice(None)]
            for key, at in zip(keys, places, strict=True):
                mine = values[at]
                parts, size, low, high = held.get(key, ([], 0, math.inf, -math.inf))
                parts.append((mine, np.ones(len(mine))))
                size += len(mine)
                if size > BUFFER:
                    parts, size = [squeezed(parts)], 0
                held[key] = (parts, size, min(low, mine.min()), max(high, mine.max()))
            if len(held) > KEYS:
                yield rows_out()
        if held:
            yield rows_out()

    partial = rows.mapInArrow(digest, schema)
    return tdigest_merge(tdigest_merge(partial, [*by, "_task"], compression), by, compression)


def tdigest_merge(digests: DataFrame, by: Sequence[str] = (), compression: int = COMPRESSION) -> DataFrame:
    """Stored digests, merged into one per key ``by``."""
    schema = _digest_schema(digests, by)
    arrow, n = to_arrow_schema(schema), len(by)

    def merge(table):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        means, weights = (pc.list_flatten(table[c]).to_numpy() for c in ("means", "weights"))
        means, weights = _compress(np.asarray(means), np.asarray(weights), compression)
        row = [*[table[c][0].as_py() for c in table.column_names[:n]], means, weights,
               pc.min(table["low"]).as_py(), pc.max(table["high"]).as_py()]
        return pa.Table.from_arrays([pa.array([x], f.type) for x, f in zip(row, arrow, strict=True)], schema=arrow)

    rows = digests.select(*by, "means", "weights", "low", "high")
    return rows.groupBy(*by).applyInArrow(merge, schema)


def tdigest_percentiles(digests: DataFrame, percents: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """(by…, percent, value) of one digest per key."""
    wanted = [float(p) for p in percents]

    @F.arrow_udf("array<double>")
    def found(means, weights, low, high):
        import numpy as np
        import pyarrow as pa

        return pa.array([
            _quantile(np.asarray(m), np.asarray(w), a, b, np.asarray(wanted) / 100) for m, w, a, b in zip(
                means.to_pylist(), weights.to_pylist(), low.to_pylist(), high.to_pylist(), strict=True)],
            pa.list_(pa.float64()))

    names = F.array(*[F.lit(p) for p in wanted])
    values = found(F.col("means"), F.col("weights"), F.col("low"), F.col("high"))
    return digests.withColumn("_x", values).select(*by, F.explode(F.arrays_zip(
        names.alias("percent"), F.col("_x").alias("value"))).alias("_x")).select(*by, "_x.percent", "_x.value")


# ---- roll-up of Spark's own sketches -------------------------------------------------


def roll_up(stored: DataFrame, by: Sequence[str], quantiles: Sequence[str] = (), distinct: Sequence[str] = (),
            counts: Sequence[str] = ()) -> DataFrame:
    """Stored rows of sketches (``facets.percentile_sketch``, ``facets.distinct_sketch``) and counts, merged into the
    keys ``by`` under the same names."""
    return stored.groupBy(*by).agg(
        *[F.kll_merge_agg_double(c).alias(c) for c in quantiles],
        *[F.hll_union_agg(c).alias(c) for c in distinct], *[F.sum(c).alias(c) for c in counts])


def sketched_percentile(sketch, percent: float) -> Column:
    return F.kll_sketch_get_quantile_double(col(sketch), F.lit(percent / 100))


def sketched_distinct(sketch) -> Column:
    return F.hll_sketch_estimate(col(sketch))

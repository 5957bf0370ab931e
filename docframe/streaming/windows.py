"""Windowed metrics with watermarks, on streams and on stored tables alike."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import duration_micros, epoch_micros, from_micros


def window_metrics(df: DataFrame, ts: str, size: str, metrics: dict[str, Column],
                   slide: str | None = None, by: Sequence[str] = (),
                   late: str | None = None) -> DataFrame:
    """Tumbling (or, with ``slide``, sliding) windows. ``late`` is how long a stream waits
    for late rows (on a timestamp with zone); rows later than that are dropped."""
    rows = df.withWatermark(ts, late) if late else df
    window = F.window(ts, size, slide) if slide else F.window(ts, size)
    return _windowed(rows.groupBy(window.alias("w"), *by), by, metrics)


def _windowed(groups, by, metrics: dict[str, Column]) -> DataFrame:
    return groups.agg(*[c.alias(n) for n, c in metrics.items()]).select(
        F.col("w.start").alias("start"), F.col("w.end").alias("end"), *by, *metrics)


def session_stream(stream: DataFrame, ts: str, gap: str, by: Sequence[str],
                   metrics: dict[str, Column], late: str) -> DataFrame:
    rows = stream.withWatermark(ts, late)
    return _windowed(rows.groupBy(F.session_window(ts, gap).alias("w"), *by), by, metrics)


def sessions(df: DataFrame, ts: str, gap: str, by: str, value: str) -> DataFrame:
    """Sessions of a stored table: (by, start, end, n, total); ``end`` is the last row's
    time plus the gap.

    Rows of one cell of width ``gap`` are always one session, so they are summed up per
    cell before anything is ordered. What a single key brings to the ordered step is then
    bounded by the time span over the gap, however many rows it has.
    """
    width = duration_micros(gap)
    us = epoch_micros(F.col(ts))
    cells = (
        df.where(F.col(ts).isNotNull()).withColumn("_t", us)
        .groupBy(by, F.floor(F.col("_t") / width).alias("_cell"))
        .agg(F.min("_t").alias("_lo"), F.max("_t").alias("_hi"),
             F.count(F.lit(1)).alias("_n"), F.sum(value).alias("_v"))
    )
    ordered = Window.partitionBy(by).orderBy("_cell")
    fresh = F.coalesce(F.col("_lo") - F.lag("_hi").over(ordered) > width, F.lit(True))
    numbered = cells.withColumn("_new", fresh.cast("long")).withColumn(
        "_s", F.sum("_new").over(ordered))
    return numbered.groupBy(by, "_s").agg(
        F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"),
        F.sum("_n").alias("n"), F.sum("_v").alias("total"),
    ).select(by, from_micros(F.col("_lo")).alias("start"),
             from_micros(F.col("_hi") + F.lit(width)).alias("end"), "n", "total")


def first_seen(stream: DataFrame, keys: Sequence[str], ts: str, late: str) -> DataFrame:
    """Each key once within the watermark, for sources that deliver rows again."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark(list(keys))

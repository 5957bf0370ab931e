"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, keyed, ranked, unit, without

BROADCAST_SOURCES = 10_000
TAIL = 12


def poisson_cdf(mean: Column) -> Column:
    """P(X <= 0), P(X <= 1), ... as an array, so far that the rest is below 2^-52. Terms are
    carried as logarithms, so that large means do not underflow."""
    last = F.ceil(mean + TAIL * F.sqrt(mean) + 30).cast("int")
    first = F.exp(-mean)
    steps = F.aggregate(
        F.sequence(F.lit(1), last),
        F.struct((-mean).alias("log"), first.alias("sum"), F.array(first).alias("all")),
        lambda s, k: F.struct(
            (s["log"] + F.log(mean) - F.log(k.cast("double"))).alias("log"),
            (s["sum"] + F.exp(s["log"] + F.log(mean) - F.log(k.cast("double")))).alias("sum"),
            F.concat(s["all"], F.array(
                s["sum"] + F.exp(s["log"] + F.log(mean) - F.log(k.cast("double"))))).alias("all"),
        ),
    )["all"]
    return F.when(mean > 0, steps).otherwise(F.array(F.lit(1.0)))


def rates(df: DataFrame, source: str = "source", size: Column | None = None,
          weights: DataFrame | None = None, temperature: float = 0.5, epochs: float = 1.0
          ) -> DataFrame:
    """One row per source: (source, size, rate). The rate is the mean number of copies of each
    document that gives the source its target share of ``epochs`` times the whole size.

    ``weights`` (source, weight) names target shares; sources it leaves out get none. Without
    it, shares are in proportion to size to the power ``temperature``."""
    size = F.lit(1) if size is None else size
    sizes = df.groupBy(F.col(source).alias("source")).agg(
        F.sum(size.cast("double")).alias("size"))
    if weights is None:
        sizes = sizes.withColumn("weight", F.pow("size", F.lit(temperature)))
    else:
        named = weights.select(F.col("source").alias("_name"), F.col("weight").cast("double"))
        sizes = sizes.join(named, F.col("source").eqNullSafe(F.col("_name")), "left").select(
            "source", "size", F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(0.0))
            .alias("weight"))
    whole = sizes.agg(F.sum("size").alias("_size"), F.sum("weight").alias("_weight"))
    rate = F.when((F.col("size") > 0) & (F.col("_weight") > 0),
                  F.col("_size") * epochs * F.col("weight") / F.col("_weight") / F.col("size"))
    return sizes.join(F.broadcast(whole)).select(
        "source", "size", F.coalesce(rate, F.lit(0.0)).alias("rate"))


def mix(df: DataFrame, table: DataFrame, id_col: str = "doc_id", source: str = "source",
        seed: str = "mix", buckets: int = 4096) -> DataFrame:
    """Every document as often as a Poisson draw with its source's rate says, in a global
    random order.

    The draw inverts the distribution at a uniform number hashed from (seed, id), so a retried
    task draws the same. Adds ``copy`` (from 1), ``copies`` and ``position`` (gapless from 0
    over the whole result); columns of these names are replaced. Rows are alike if their ids
    are: repeated rows are drawn alike, a NULL id draws as an empty one, a NULL source is a
    source of its own. Empty tables stay empty. Each position bucket is sorted by itself, so a
    source that holds a third of the rows is spread over all tasks."""
    cols = [c for c in df.columns if c.lower() not in ("copy", "copies", "position")]
    df = without(df, "copy", "copies", "position")
    key, cdf, name = (free_name(df, c) for c in ("_key", "_cdf", "_name"))
    drawn = table.select(F.col("source").alias(name), poisson_cdf(F.col("rate")).alias(cdf))
    if len(table.select("source").take(BROADCAST_SOURCES + 1)) <= BROADCAST_SOURCES:
        drawn = F.broadcast(drawn)
    u = unit(keyed(F.lit(seed), F.col(id_col)))
    copies = df.join(drawn, F.col(f"`{source}`").eqNullSafe(F.col(name))).withColumn(
        "copies", F.size(F.filter(F.col(cdf), lambda c: c <= u))).where("copies > 0")
    copies = copies.select(
        *[F.col(f"`{c}`") for c in cols], "copies",
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    spread = copies.withColumn(key, keyed(F.lit(seed), F.lit("place"), F.col(id_col), F.col("copy")))
    ties = [F.col(f"`{id_col}`"), F.col("copy"), F.xxhash64(*[F.col(f"`{c}`") for c in cols])]
    return ranked(spread, "position", key, ties, buckets=buckets).select(
        *[F.col(f"`{c}`") for c in cols], "copy", "copies", "position")

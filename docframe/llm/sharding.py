"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, free_name, keyed, ranked, unit, without

SPREAD = 12
PART_ROWS = 1 << 20
CELL_ROWS = 1 << 16


def _doubled(least: int, wanted: float) -> int:
    """``least``, doubled until it is no less than ``wanted``."""
    while least < wanted:
        least *= 2
    return least


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), 0)


def hypergeometric(whole: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """How many of ``drawn`` rows, taken without putting back from ``whole`` rows of which
    ``marked`` are marked, are marked: the distribution inverted at ``u``. Weights run over twelve standard
    deviations round the mean (what lies beyond is below 1e-30), each a ratio of the one before, and
    are divided by their own sum, so that their error does not grow with the table."""

    def bounds(v: Column) -> Column:
        big, k, n = v["big"], v["k"], v["n"]
        mean = F.when(big > 0, n * k / big).otherwise(0.0)
        sd = F.when(big > 1, F.sqrt(F.greatest(
            n * (k / big) * (1 - k / big) * (big - n) / (big - 1), F.lit(0.0)))).otherwise(0.0)
        reach = SPREAD * sd + SPREAD
        return F.struct(
            big.alias("big"), k.alias("k"), n.alias("n"), v["u"].alias("u"),
            F.greatest(F.lit(0.0), n - (big - k), F.floor(mean - reach).cast("double"))
            .alias("low"),
            F.least(n, k, F.ceil(mean + reach).cast("double")).alias("high"))

    def invert(v: Column) -> Column:
        big, k, n, low = v["big"], v["k"], v["n"], v["low"]

        def following(p: Column, x: Column) -> Column:
            return p * (k - x) * (n - x) / ((x + 1) * F.greatest(big - k - n + x + 1, F.lit(1.0)))

        values = F.sequence(low.cast("long"), v["high"].cast("long"))
        whole_sum = F.aggregate(
            values, F.struct(F.lit(1.0).alias("p"), F.lit(0.0).alias("sum")),
            lambda s, x: F.struct(following(s["p"], x).alias("p"), (s["sum"] + s["p"]).alias("sum")),
        )["sum"]
        found = _let(v["u"] * whole_sum, lambda goal: F.aggregate(
            values, F.struct(F.lit(1.0).alias("p"), F.lit(0.0).alias("sum"), low.cast("long").alias("value")),
            lambda s, x: _let(s["sum"] + s["p"], lambda held: F.struct(
                following(s["p"], x).alias("p"), held.alias("sum"),
                (s["value"] + F.when(held <= goal, 1).otherwise(0)).alias("value"))))["value"])
        return F.least(found, v["high"].cast("long"))

    return _let(F.struct(
        whole.cast("double").alias("big"), marked.cast("double").alias("k"),
        drawn.cast("double").alias("n"), u.alias("u")), lambda v: _let(bounds(v), invert))


def _left_half(node: Column, drawn: Column, shards: int, seed: str) -> Column:
    """How many of a node's rows for each shard fall into its left half of ``drawn`` rows."""
    start = F.struct(
        F.aggregate(node["cols"], F.lit(0).cast("long"), lambda a, x: a + x).alias("whole"),
        drawn.alias("drawn"), F.array().cast("array<long>").alias("out"))

    def step(s: Column, i: Column) -> Column:
        marked = F.get(node["cols"], i)
        u = unit(keyed(F.lit(seed), F.lit("cell"), node["lo"], node["hi"], i))
        return _let(hypergeometric(s["whole"], marked, s["drawn"], u), lambda cell: F.struct(
            (s["whole"] - marked).alias("whole"), (s["drawn"] - cell).alias("drawn"),
            F.concat(s["out"], F.array(cell)).alias("out")))

    return F.aggregate(F.sequence(F.lit(0), F.lit(shards - 1)), start, step)["out"]


def communication_matrix(counts: DataFrame, shards: int, partitions: int, seed: str) -> DataFrame:
    """(partition, cells): how many rows of each source partition go to each shard, drawn as a
    uniform shuffle of all rows would send them. Row sums are the partitions' counts, column
    sums the shards' sizes.

    ``counts`` holds (partition, n). Partitions are halved again and again; each half's share of
    every shard is one hypergeometric draw, so a level's nodes are drawn independently."""
    sizes = counts.agg(F.map_from_entries(F.collect_list(F.struct("partition", "n"))).alias("m"))
    sizes = sizes.select(F.transform(
        F.sequence(F.lit(0), F.lit(partitions - 1)),
        lambda p: F.coalesce(F.try_element_at("m", p.cast("long")), F.lit(0).cast("long"))
    ).alias("sizes"))
    whole = F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)
    nodes = sizes.withColumn("whole", whole).select(F.struct(
        F.lit(0).alias("lo"), F.lit(partitions).alias("hi"), F.col("sizes").alias("sizes"),
        F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: (
            F.floor(F.col("whole") / shards) + F.when(s < F.col("whole") % shards, 1).otherwise(0)
        ).cast("long")).alias("cols")).alias("node"))
    node = F.col("node")
    half = ((node["hi"] - node["lo"]) / 2).cast("int")
    sum_left = F.aggregate(
        F.slice(node["sizes"], 1, half), F.lit(0).cast("long"), lambda a, x: a + x)
    left_cells = _left_half(node, sum_left, shards, seed)
    left = F.struct(
        node["lo"].alias("lo"), (node["lo"] + half).alias("hi"),
        F.slice(node["sizes"], 1, half).alias("sizes"), F.col("left").alias("cols"))
    right = F.struct(
        (node["lo"] + half).alias("lo"), node["hi"].alias("hi"),
        F.slice(node["sizes"], half + 1, half).alias("sizes"),
        F.zip_with(node["cols"], "left", lambda a, b: a - b).alias("cols"))
    for _ in range(partitions.bit_length() - 1):
        nodes = nodes.withColumn("left", left_cells).select(
            F.explode(F.array(left, right)).alias("node"))
    return nodes.select(F.col("node.lo").cast("long").alias("partition"),
                        F.col("node.cols").alias("cells"))


def shard(df: DataFrame, shards: int = 24, partitions: int | None = None, id_col: str = "doc_id",
          seed: str = "shard", buckets: int | None = None) -> DataFrame:
    """Every row once, with ``shard`` and ``slot`` (gapless from 0 in each shard): a uniform
    random order of the whole table, cut into shards whose row counts are at most one apart.

    Rows are dealt by a hash of their id into ``partitions`` (a power of two; unless given, 64 doubled
    until a partition has at most about ``PART_ROWS`` rows) source partitions and ordered at random in each. The communication matrix says how many of the
    first, next, ... rows go to which shard; they are exchanged and ordered at random again, a shard
    in ``buckets`` (256, doubled until one has at most about ``CELL_ROWS`` rows).
    All random numbers are hashes of (seed, id), ties are broken by the row's content, and equal
    rows are interchangeable, so a lost task is redone alike. A NULL id is dealt like an
    empty one. Empty tables stay empty; with fewer rows than shards the last shards are empty.
    Extra columns pass through; columns named shard or slot are replaced."""
    if partitions is None or buckets is None:
        rows = df.count()
        partitions = partitions or _doubled(64, rows / PART_ROWS)
        buckets = buckets or _doubled(256, rows / shards / CELL_ROWS)
    if partitions < 1 or partitions & (partitions - 1):
        raise ValueError("partitions must be a power of two")
    df = without(df, "shard", "slot")
    cols = df.columns
    part, rank, cells, key = (free_name(df, c) for c in ("_part", "_rank", "_cells", "_key"))
    id_ = F.col(f"`{id_col}`")
    dealt = df.withColumn(part, keyed(F.lit(seed), F.lit("deal"), id_) % partitions)
    # written once: the draws are a small table, but a large expression to plan again and again
    matrix = cut(communication_matrix(
        cut(dealt.groupBy(F.col(part).alias("partition")).agg(F.count("*").alias("n"))),
        shards, partitions, seed))
    matrix = matrix.select(F.col("partition").alias(part), F.aggregate(
        "cells", F.array(F.lit(0).cast("long")),
        lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x))).alias(cells))
    ties = [id_, F.xxhash64(*[F.col(f"`{c}`") for c in cols])]
    mixed = dealt.withColumn(key, keyed(F.lit(seed), F.lit("local"), id_))
    mixed = ranked(mixed, rank, key, ties, [part], PART_ROWS // CELL_ROWS)
    # partitions x shards numbers, both parameters
    sent = mixed.join(F.broadcast(matrix), part).withColumn("shard", (F.size(F.filter(
        F.col(cells), lambda c: c <= F.col(rank))) - 1).cast("int"))
    sent = sent.withColumn(key, keyed(F.lit(seed), F.lit("slot"), id_))
    return ranked(sent, "slot", key, ties, ["shard"], buckets).select(
        *[F.col(f"`{c}`") for c in cols], "shard", "slot")

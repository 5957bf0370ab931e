"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut


def _is_stars(links: DataFrame) -> bool:
    """Whether every node has either one smaller neighbour, or larger ones only: nothing is left to be hung anew."""
    ends = links.select(F.explode(F.array(
        F.struct(F.col("a").alias("node"), F.lit(0).alias("below")),
        F.struct(F.col("b").alias("node"), F.lit(1).alias("below")))).alias("end")).select("end.*")
    return ends.groupBy("node").agg(F.sum("below").alias("n"), F.min("below").alias("least")).where(
        "n > 1 or n > least").isEmpty()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node that links (a, b) reach, for every node of a link.

    Each round hangs a node's larger neighbours on its smallest one, then its smaller ones (the
    large-star and small-star steps of Kiveris et al. 2014), until all links are stars; a round
    needs a few shuffles of the links and is written to shared storage. The neighbours of a hub
    are never gathered: a node's minimum is summed up before it is joined to its links."""

    def both_of(*links: tuple[str, str]) -> Column:
        return F.explode(F.array(*[F.struct(F.col(x).alias("a"), F.col(y).alias("b")) for x, y in links])).alias("l")

    links = cut(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                .where("a <> b").distinct())
    for _ in range(max_rounds):
        if _is_stars(links):
            break
        both = links.select(both_of(("a", "b"), ("b", "a"))).select("l.*")
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(
            "a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("b"), F.col("m").alias("a"))
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        links = cut(large.join(low, "b").select(both_of(("m", "a"), ("m", "b"))).select("l.*")
                    .where("a <> b").distinct())
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    return links.select(both_of(("a", "a"), ("a", "b"))).select(
        F.col("l.b").alias("node"), F.col("l.a").alias("component")).distinct()

"""Running totals in the order of a value, over range partitions: no task sees all rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.lineage import stored

BEFORE = (Window.unboundedPreceding, -1)


def running(df: DataFrame, order: Sequence[str], totals: Mapping[str, str]) -> DataFrame:
    """Every row with the sum of each column (``totals``: column -> name) over the rows that sort
    before it.

    Rows are dealt to partitions by ranges of ``order`` and stored with their partition's number. Each partition is
    summed up in one row; those few rows are scanned in order, and what lies before a partition is added to the sums inside it.
    Rows that are equal in ``order`` should be summed up before: they share a partition, and which of them comes first
    is not defined."""
    parts = stored(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    zero = {c: F.lit(0).cast(parts.schema[c].dataType) for c in totals}
    per_part = parts.groupBy("_part").agg(*[F.sum(c).alias(f"_from_{c}") for c in totals])
    over_parts = Window.orderBy("_part").rowsBetween(*BEFORE)
    starts = per_part.select("_part", *[F.coalesce(F.sum(f"_from_{c}").over(over_parts), zero[c]).alias(
        f"_from_{c}") for c in totals])
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(*BEFORE)
    return parts.join(starts, "_part").withColumns({
        name: F.col(f"_from_{c}") + F.coalesce(F.sum(c).over(inside), zero[c]) for c, name in totals.items()
    }).drop("_part", *[f"_from_{c}" for c in totals])


def range_table(df: DataFrame, field: str, ranges: DataFrame, low: str = "from", high: str = "to",
                sums: Sequence[str] = ()) -> DataFrame:
    """Every row of ``ranges`` with ``doc_count`` and ``sum_<column>``: how many rows of ``df`` have ``low`` <=
    field < ``high``, and their sums. NULL leaves a side open; NULL values lie in no range; a range that
    ends before it starts is empty. Ranges may overlap, repeat and carry other columns.

    No row meets a range: values and distinct range ends are swept once in order, and a range is the difference of
    the totals at its ends. So the work grows with rows plus ranges, not with how many overlap. Sums of doubles are differences of
    running sums, exact as long as those are (whole numbers below 2^53, decimals)."""
    added = {c: F.sum(c).alias(f"_s{i}") for i, c in enumerate(sums)}
    values = df.select(F.col(field).alias("_v"), *sums).where(F.col("_v").isNotNull()).groupBy("_v").agg(
        F.count(F.lit(1)).alias("_n"), *added.values()).withColumn("_kind", F.lit(1))
    cells = ["_n", *[f"_s{i}" for i in range(len(sums))]]
    values = values.withColumns({c: F.coalesce(c, F.lit(0).cast(values.schema[c].dataType)) for c in cells})
    kind = values.schema["_v"].dataType
    ends = ranges.select(F.col(low).cast(kind).alias("_v")).union(
        ranges.select(F.col(high).cast(kind))).where(F.col("_v").isNotNull()).distinct()
    ends = ends.select("_v", *[F.lit(0).cast(values.schema[c].dataType).alias(c) for c in cells],
                       F.lit(0).alias("_kind"))
    below = {c: f"{c}_below" for c in cells}
    # at one value the end of a range comes first: what lies below it is less than it
    swept = running(values.unionByName(ends), ["_v", "_kind"], below).where("_kind = 0")
    whole = values.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(f"{c}_all") for c in cells])

    def at(side: str) -> DataFrame:
        return swept.select(F.col("_v").alias(f"_{side}"), *[F.col(b).alias(f"{c}_{side}")
                                                             for c, b in below.items()])

    joined = ranges.withColumns({"_low": F.col(low).cast(kind), "_high": F.col(high).cast(kind)}).join(
        at("low"), "_low", "left").join(at("high"), "_high", "left").crossJoin(whole)  # one row
    full = F.coalesce(F.col("_low") < F.col("_high"), F.lit(True))

    def between(c: str):
        upto = F.when(F.col("_high").isNull(), F.col(f"{c}_all")).otherwise(F.col(f"{c}_high"))
        zero = F.lit(0).cast(values.schema[c].dataType)
        return F.when(full, upto - F.coalesce(f"{c}_low", zero)).otherwise(zero)

    return joined.select(*ranges.columns, between("_n").alias("doc_count"), *[
        between(f"_s{i}").alias(f"sum_{c}") for i, c in enumerate(sums)])

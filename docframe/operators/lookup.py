"""Fetching rows of another table: by id, as lists per row, and refreshes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .paging import sort_columns


def _asked(table: DataFrame, key: str, ids: DataFrame, column: str) -> DataFrame:
    """The rows of ``table`` that some id asks for: Spark broadcasts the ids if they are few."""
    wanted = ids.select(F.col(column).alias("_asked")).where(F.col("_asked").isNotNull()).distinct()
    return table.join(wanted, F.col(key) == F.col("_asked"), "left_semi")


def get_by_ids(ids: DataFrame, docs: DataFrame, key: str) -> DataFrame:
    """One row per asked id with ``found``; fields are null where there is no such row."""
    found = _asked(docs, key, ids, key).withColumn("found", F.lit(True))
    return ids.select(key).distinct().join(found, key, "left").withColumn(
        "found", F.coalesce("found", F.lit(False)))


def get_missing(ids: DataFrame, docs: DataFrame, key: str) -> DataFrame:
    return ids.select(key).distinct().join(
        _asked(docs.select(key), key, ids, key), key, "left_anti")


# Parts that a key's matches are cut into before the best are taken.
SALTS = 64


@dataclass(frozen=True)
class Lookup:
    """Rows of ``other`` whose ``right`` equals this row's ``left``, as a list ``name``."""

    name: str
    other: DataFrame
    left: str
    right: str
    select: Sequence[str]
    sort: object
    tie: str
    size: int | None = None  # all matches unless a page size is named


def lookup(df: DataFrame, step: Lookup) -> DataFrame:
    """Adds ``name`` (the matches, sorted; the first ``size`` if a size is named) and
    ``name_total``.

    Only rows that some row asks for take part. One key may have any share of them: its matches are counted by partial
    sums, and with a size the best of each of ``SALTS`` parts of a key are taken first, so no window sees a whole
    key. Without a size a list is as long as its key has matches; ``lookup_rows`` gives them as rows.
    """
    k, total = f"_{step.name}_key", f"{step.name}_total"
    rows = _asked(step.other, step.right, df, step.left).withColumn(k, F.col(step.right))
    order = sort_columns(step.sort, step.tie)
    counted = rows.groupBy(k).agg(F.count(F.lit(1)).alias("_n"))
    if step.size is not None:
        salted = rows.withColumn("_salt", F.pmod(F.xxhash64(step.tie), F.lit(SALTS)))
        part = Window.partitionBy(k, "_salt").orderBy(*order)
        rows = salted.withColumn("_rn", F.row_number().over(part)).where(F.col("_rn") <= step.size)
    numbered = rows.withColumn("_rn", F.row_number().over(Window.partitionBy(k).orderBy(*order))).select(
        k, "_rn", F.struct(*step.select).alias("_v"))
    if step.size is not None:
        numbered = numbered.where(F.col("_rn") <= step.size)
    lists = numbered.groupBy(k).agg(F.array_sort(F.collect_list(F.struct("_rn", "_v"))).alias("_l"))
    found = counted.join(lists, k).select(k, "_n", F.transform("_l", lambda x: x["_v"]).alias("_page"))
    joined = df.join(found, F.col(step.left) == F.col(k), "left").drop(k)
    kind = found.schema["_page"].dataType
    page = F.coalesce("_page", F.array().cast(kind))
    joined = joined.withColumn(total, F.coalesce("_n", F.lit(0)))
    if "." in step.left:
        parent = step.left.rsplit(".", 1)[0]
        joined = joined.withColumn(parent, F.col(parent).withField(step.name, page))
    else:
        joined = joined.withColumn(step.name, page)
    return joined.drop("_page", "_n")


def lookup_chain(df: DataFrame, steps: Sequence[Lookup], depth: int = 1) -> DataFrame:
    """Lookups inside lookups, ``depth`` levels deep; deeper levels stay null."""
    if not steps:
        return df
    step, rest = steps[0], steps[1:]
    if depth < 1:
        return df.withColumn(step.name, F.lit(None).cast("string"))
    inner = lookup_chain(step.other, rest, depth - 1)
    select = [*step.select, *([rest[0].name] if rest else [])]
    return lookup(df, Lookup(step.name, inner, step.left, step.right, select, step.sort,
                             step.tie, step.size))


def lookup_rows(df: DataFrame, other: DataFrame, left: str, right: str,
                how: str = "inner") -> DataFrame:
    """All matches as rows, for keys unique on one side (no list, no size)."""
    return df.join(other, F.col(left) == F.col(right), how)


def reload(stale: DataFrame, current: DataFrame, key: str = "_id") -> DataFrame:
    """Stale rows with their current values; rows gone meanwhile are kept as they were."""
    now = _asked(current, key, stale, key).select(key, F.struct(
        *[c for c in stale.columns if c != key and c in current.columns]).alias("_now"))
    joined = stale.join(now, key, "left")
    return joined.select(key, *[
        (F.when(F.col("_now").isNotNull(), F.col("_now")[c]).otherwise(F.col(c))).alias(c)
        if c in current.columns else F.col(c)
        for c in stale.columns if c != key
    ], F.col("_now").isNotNull().alias("_fresh"))

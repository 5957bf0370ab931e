"""Sorting, pages and totals, and set operations on results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.lineage import cut

# Fixed value: page size when none is given.
DEFAULT_SIZE = 10

SortKey = str | tuple[str, str]


def sort_columns(sort: SortKey | Sequence[SortKey], tie: str | None = None) -> list[Column]:
    """``"name"``, ``("name", "desc")`` or a list of them; missing values last both ways."""
    keys = [sort] if isinstance(sort, (str, tuple)) else list(sort)
    out = []
    for key in keys:
        name, order = (key, "asc") if isinstance(key, str) else key
        c = F.col(name)
        out.append(c.desc_nulls_last() if order == "desc" else c.asc_nulls_last())
    if tie is not None:
        out.append(F.col(tie).asc())
    return out


def sort_rows(df: DataFrame, sort=None, tie: str | None = None, default=None) -> DataFrame:
    """An explicit sort wins over the default one; neither leaves the rows as they are."""
    chosen = sort if sort is not None else default
    return df if chosen is None else df.orderBy(*sort_columns(chosen, tie))


def page_size(size: int | None) -> int:
    return DEFAULT_SIZE if size is None else size


def refuse_over(size: int | None, cap: int) -> int | None:
    """``size`` itself, for callers that bound the pages they hand out; a larger one is refused,
    never cut. The cap is at least the default size."""
    if page_size(size) > max(cap, DEFAULT_SIZE):
        raise ValueError(f"a page of {size} rows is over the cap of {cap}")
    return size


def page(df: DataFrame, sort, tie: str, number: int | None = None,
         size: int | None = None) -> DataFrame:
    """Page ``number`` (from 1). Planned as a top-k of offset+size rows, not a full sort."""
    n, width = number or 1, page_size(size)
    ordered = df.orderBy(*sort_columns(sort, tie))
    return (ordered.offset((n - 1) * width) if n > 1 else ordered).limit(width)


def numbered(rows: DataFrame, sort, tie: str, start: int = 1, name: str = "rank") -> DataFrame:
    """Rank column for one page of rows (bounded by the page size)."""
    w = Window.orderBy(*sort_columns(sort, tie))
    return rows.withColumn(name, (F.row_number().over(w) + (start - 1)).cast("long"))


def ranked(df: DataFrame, sort, tie: str, name: str = "rank") -> DataFrame:
    """Every row with its rank from 1. The sorted rows are checkpointed where they lie; a row's rank is
    its place in its partition plus the rows of the partitions before, so no task gets them all."""
    placed = cut(df.orderBy(*sort_columns(sort, tie)).withColumn("_part", F.spark_partition_id()))
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_from"))
    w = Window.partitionBy("_part").orderBy(*sort_columns(sort, tie))
    return placed.join(starts, "_part").withColumn(
        name, (F.col("_from") + F.row_number().over(w)).cast("long")).drop("_part", "_from")


def total(df: DataFrame, name: str = "total") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def page_with_total(df: DataFrame, sort, tie: str, number=None, size=None) -> DataFrame:
    """A page whose rows carry the number of hits before paging (a scalar subquery)."""
    return page(df, sort, tie, number, size).withColumn("total", total(df).scalar())


def page_after(df: DataFrame, sort: SortKey | Sequence[SortKey], tie: str, after: tuple,
               size=None) -> DataFrame:
    """The page following the row with the values ``after`` (one per sort key, then the tie).

    The bound is a filter, so deep pages cost no more than the first one. A row follows if it
    does by the first key in which it differs; missing values come last.
    """
    keys = [sort] if isinstance(sort, (str, tuple)) else list(sort)
    follows = F.col(tie) > F.lit(after[-1])
    for key, value in reversed(list(zip(keys, after[:-1], strict=True))):
        name, order = (key, "asc") if isinstance(key, str) else key
        c = F.col(name)
        if value is None:
            follows = c.isNull() & follows
        else:
            beyond = c < F.lit(value) if order == "desc" else c > F.lit(value)
            follows = beyond | c.isNull() | ((c == F.lit(value)) & follows)
    rest = df.where(follows)
    return rest.orderBy(*sort_columns(sort, tie)).limit(page_size(size))


def first(df: DataFrame, sort, tie: str) -> DataFrame:
    return df.orderBy(*sort_columns(sort, tie)).limit(1)


def union_hits(parts: Sequence[DataFrame], key: str) -> DataFrame:
    out = parts[0].select(key)
    for p in parts[1:]:
        out = out.unionByName(p.select(key))
    return out.distinct()


def intersect_hits(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.select(key).distinct().join(right.select(key), key, "left_semi")


def except_hits(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.select(key).distinct().join(right.select(key), key, "left_anti")


def keyed(df: DataFrame, key: str = "_id") -> DataFrame:
    """One row per id."""
    return df.dropDuplicates([key])

"""Versioned tables on plain Parquet: write a new folder, then append one commit row.

A reader follows the commit rows, so it never sees half a batch, and a failed write leaves
an orphan folder but no commit. One writer per table is assumed.

A table is committed whole, or by buckets of a hash of its id: then a commit rewrites only
the buckets it touched, and reads and writes of a batch cost what its buckets hold, not what
the table holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

COMMIT = ("version bigint, folder string, batch string, n_buckets int, buckets array<int>, "
          "next_seq bigint")
BUCKET = "_bucket"


def _commits(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(COMMIT).json(f"{root}/_commits")


def latest(spark: SparkSession, root: str):
    """The newest commit row, or None for a new table."""
    try:
        top = _commits(spark, root).orderBy(F.col("version").desc()).limit(1).collect()
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise
    return top[0] if top else None


def committed(spark: SparkSession, root: str, batch: str):
    """The commit row of a batch that is already in the table, or None."""
    if latest(spark, root) is None:
        return None
    done = _commits(spark, root).where(F.col("batch") == batch).limit(1).collect()
    return done[0] if done else None


def bucket_of(key: str | Column, n_buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n_buckets)).cast("int")


def touched(rows: DataFrame, key: str, n_buckets: int) -> list[int]:
    """The buckets some rows fall in: at most ``n_buckets`` numbers."""
    return sorted(r[0] for r in rows.select(bucket_of(key, n_buckets)).distinct().collect())


def commit(df: DataFrame, root: str, batch: str | None = None, key: str | None = None,
           n_buckets: int | None = None, buckets: Sequence[int] | None = None,
           next_seq: int | None = None) -> int:
    """Writes ``df`` as the next version and returns its number.

    With ``buckets`` given, ``df`` holds the whole new content of those buckets and the
    others stay as they are. With ``batch`` given, a batch already committed is not written
    again, so a replayed streaming batch changes nothing.
    """
    spark = df.sparkSession
    last = latest(spark, root)
    if batch is not None:
        done = committed(spark, root, batch)
        if done is not None:
            return done["version"]
    if last is not None and last["n_buckets"] != n_buckets:
        raise ValueError(f"the table has {last['n_buckets']} buckets, not {n_buckets}")
    version = 1 if last is None else last["version"] + 1
    folder = f"v{version}"
    if n_buckets:
        df = df.withColumn(BUCKET, bucket_of(key, n_buckets)).hint("rebalance", BUCKET)
    writer = df.write.mode("overwrite")  # only ever an orphan of a failed attempt
    (writer.partitionBy(BUCKET) if n_buckets else writer).parquet(f"{root}/{folder}")
    whole = list(range(n_buckets)) if n_buckets and buckets is None else buckets
    row = spark.createDataFrame([(version, folder, batch, n_buckets, whole, next_seq)], COMMIT)
    row.coalesce(1).write.mode("append").json(f"{root}/_commits")
    return version


def read(spark: SparkSession, root: str, version: int | None = None,
         buckets: Sequence[int] | None = None) -> DataFrame | None:
    """A version of the table (the newest by default), or only some of its buckets."""
    last = latest(spark, root)
    if last is None:
        return None
    at = version or last["version"]
    if not last["n_buckets"]:
        return spark.read.parquet(f"{root}/v{at}")
    owners = _commits(spark, root).where(F.col("version") <= at).select(
        "version", F.explode("buckets").alias("b")).groupBy("b").agg(F.max("version").alias("v"))
    if buckets is not None:
        owners = owners.where(F.col("b").isin(list(buckets)))
    held: dict[int, list[int]] = {}
    for r in owners.collect():  # one row per bucket at most
        held.setdefault(r["v"], []).append(r["b"])
    shape = spark.read.parquet(f"{root}/v{at}").schema
    out = None
    for v, which in sorted(held.items()):
        part = spark.read.schema(shape).parquet(f"{root}/v{v}").where(F.col(BUCKET).isin(which))
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = spark.read.parquet(f"{root}/v{at}").limit(0)
    return out.drop(BUCKET)

"""What the operators share: keyed uniform numbers, exact ranks, row identity, shared storage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.lineage import shared_folder

KEY_BITS = 52
SPACES = " \t\n\x0b\f\r"
"""Fixed values: the bytes 0x20 and 0x09 to 0x0D, which end a word."""


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """``checkpoint()`` into the folder the cluster names in ``spark.checkpoint.dir``."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()


@contextmanager
def workspace(spark: SparkSession) -> Iterator[str]:
    """A shared folder for tables that are ``stored`` for one piece of work. It goes when the block ends, so
    what is read later is ``cut`` inside it."""
    folder = f"{shared_folder(spark)}/tables/{uuid.uuid4().hex}"
    try:
        yield folder
    finally:
        context = spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, folder: str | None = None) -> DataFrame:
    """``df`` written as Parquet into the shared folder (or a ``workspace``) and read again: what ``cut`` does,
    compressed."""
    spark = df.sparkSession
    path = f"{folder or shared_folder(spark) + '/tables'}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def keyed(*parts: Column | str) -> Column:
    """A uniform whole number below 2^52 that depends on the parts' text alone. NULL parts
    count as empty."""
    text = F.concat_ws("|", *[F.coalesce(
        (F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long")


def unit(key: Column) -> Column:
    """``keyed`` as a number in [0, 1)."""
    return key.cast("double") / F.lit(float(1 << KEY_BITS))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns an operator is about to add, in any case."""
    gone = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in gone])


def ranked(df: DataFrame, name: str, key: str, ties: Sequence[Column], groups: Sequence[str] = (),
           buckets: int = 4096) -> DataFrame:
    """Adds the gapless rank from 0 of every row in the order of ``key`` (``keyed``), per group
    if groups are named. No task holds more than one bucket of the key range of one group: the
    buckets are counted first, and a row's rank is its bucket's start plus its place there."""
    bucket = free_name(df, "_bucket")
    start = free_name(df, "_start")
    cells = df.withColumn(bucket, (F.col(key) / F.lit((1 << KEY_BITS) // buckets)).cast("long"))
    before = Window.orderBy(bucket)
    if groups:
        before = Window.partitionBy(*groups).orderBy(bucket)
    starts = cells.groupBy(*groups, bucket).agg(F.count("*").alias(start)).withColumn(
        start, F.coalesce(F.sum(start).over(before.rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)))
    on = [*groups, bucket]
    # at most ``buckets`` rows per group, which the callers bound
    out = cells.join(F.broadcast(starts), on)
    within = Window.partitionBy(*on).orderBy(key, *ties)
    return out.withColumn(name, F.col(start) + F.row_number().over(within) - 1).drop(bucket, start)


def in_words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text as an array; NULL has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often ``use`` names it: lambdas
    work out what they name from outside anew for every element."""
    return F.get(F.transform(F.array(value), use), 0)


def pairs(batch: pa.RecordBatch, a: str, b: str, step: int = 256) -> Iterator[tuple]:
    """The rows' two values, made into Python objects a few rows at a time."""
    for at in range(0, batch.num_rows, step):
        part = batch.slice(at, step)
        yield from zip(part.column(a).to_pylist(), part.column(b).to_pylist(), strict=True)

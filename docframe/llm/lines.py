"""Line dedup by overlapping windows of three lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES, free_name, without

WIDTH = 3


def repeated_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   width: int = WIDTH) -> DataFrame:
    """(row key, lines to remove) of the texts that hold a later occurrence of a window.

    Lines are what newlines part, without blanks at their ends; lines of blanks only belong to
    no window. A window is ``width`` lines in a row among the others. Of all places where a
    window occurs, the one with the smallest (id, key of the row, place) is kept; the lines of
    all later ones are covered."""
    lines = F.split(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), "\n", -1)
    lines = F.transform(lines, lambda x, i: F.struct(
        i.alias("at"), F.trim(F.translate(x, SPACES, " " * len(SPACES))).alias("line")))
    full = F.filter(lines, lambda x: x["line"] != "")
    rows = df.select(
        F.col(f"`{id_col}`").alias("id"),
        F.xxhash64(f"`{id_col}`", f"`{text_col}`").alias("row"), full.alias("full")
    ).where(F.size("full") >= width)
    windows = rows.select("id", "row", F.posexplode(F.transform(
        F.sequence(F.lit(0), F.size("full") - width),
        lambda i: F.struct(
            F.xxhash64(*[F.get(F.col("full"), i + k)["line"] for k in range(width)]).alias("window"),
            F.array(*[F.get(F.col("full"), i + k)["at"] for k in range(width)]).alias("covers"),
        ))).alias("place", "w")).select("id", "row", "place", "w.window", "w.covers")
    here = F.struct("id", "row", "place")
    firsts = windows.groupBy("window").agg(F.min(here).alias("first"), F.max(here).alias("last"))
    firsts = firsts.where(F.col("first") != F.col("last")).select("window", "first")
    later = windows.join(firsts, "window").where(F.struct("id", "row", "place") != F.col("first"))
    # one partial set per task: places of a hot window are spread over their documents
    return later.select("row", F.explode("covers").alias("at")).groupBy("row").agg(
        F.collect_set("at").alias("covered"))


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                width: int = WIDTH) -> DataFrame:
    """Every row, its text without the lines that only repeat an earlier window, and
    ``lines`` / ``removed_lines``.

    The kept lines are joined by newlines, unchanged. A NULL text stays NULL with no lines; a
    text left without lines is empty; texts of fewer than ``width`` lines stay whole. Rows
    alike in id and text are one place and lose the same lines; a NULL id sorts first. Extra
    columns pass through; ones named like an added column are replaced."""
    df = without(df, "lines", "removed_lines")
    row, covered = free_name(df, "_row"), free_name(df, "_covered")
    hits = repeated_lines(df, id_col, text_col, width).select(
        F.col("row").alias(row), F.col("covered").alias(covered))
    text = F.col(f"`{text_col}`")
    parts = F.split(text, "\n", -1)
    out = df.withColumn(row, F.xxhash64(f"`{id_col}`", f"`{text_col}`")).join(hits, row, "left")
    kept = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col(covered))
    rest = F.concat_ws("\n", F.transform(kept, lambda i: F.get(parts, i)))
    return out.withColumn(
        "lines", F.when(text.isNull(), 0).otherwise(F.size(parts)).cast("long")).withColumn(
        "removed_lines", F.coalesce(F.size(F.array_distinct(covered)), F.lit(0)).cast("long")
    ).withColumn(text_col, F.when(F.col(covered).isNull(), text).otherwise(rest)).drop(row, covered)

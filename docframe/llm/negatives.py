"""Hard negatives: inner-product joins with thresholds that fall until each window is full."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

LARGEST = 1 << 20
EXACT = float(1 << 52)
WIDTH = 8
BLOCK_ROWS = 4096
BLOCK_ANCHORS = 256
CELL_NUMBERS = 1 << 22
CELL_ANCHORS = 2048
FEW = 0.08
POSITIVE_STEPS = (0.6, 0.35, 0.15)
WINDOW_STEPS = (0.25, 0.5)
LAST = np.iinfo(np.int64).max
Found = tuple[np.ndarray, np.ndarray, np.ndarray]


def prepared(df: DataFrame, anchors: Column, id_col: str, label_col: str, vector_col: str,
             scale: float) -> DataFrame:
    """(key, id, label, vector, anchor) of the rows that take part: a number for each row, and the whole
    numbers floor(scale * x) for its components."""
    x = F.col(f"`{vector_col}`").cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    limit = F.lit(float(LARGEST))
    return df.where(F.col(f"`{label_col}`").isNotNull() & x.isNotNull() & finite).select(
        F.monotonically_increasing_id().alias("key"), F.col(f"`{id_col}`").cast("long").alias("id"),
        F.col(f"`{label_col}`").cast("string").alias("label"),
        F.transform(x, lambda v: F.floor(F.greatest(F.least(v * float(scale), limit), -limit)).cast(
            "int")).alias("vector"), F.coalesce(anchors, F.lit(False)).alias("anchor"))


def _remaining(x: np.ndarray, groups: list[slice]) -> np.ndarray:
    """The norms of what is left of each row from each group on; 0 after the last."""
    energy = np.column_stack([*[(x[:, g] ** 2).sum(axis=1) for g in groups], np.zeros(len(x))])
    return np.sqrt(np.cumsum(energy[:, ::-1], axis=1)[:, ::-1])


class Index:
    """An inverted index of a block of vectors, for thresholds of at least ``tau`` times the norm of the
    vector that asks.

    Dimensions with the most energy come first, in groups of ``WIDTH``. A vector has no postings from the
    group on where its remaining norm is below ``tau``: what is left cannot reach a threshold by
    itself. That part is kept aside and finishes the scores of candidates."""

    def __init__(self, vectors: np.ndarray, tau: float):
        self.order = np.argsort(-(vectors * vectors).sum(axis=0), kind="stable")
        self.whole = vectors[:, self.order]
        self.groups = [slice(k, min(k + WIDTH, vectors.shape[1])) for k in range(0, vectors.shape[1], WIDTH)]
        self.rest = _remaining(self.whole, self.groups)
        posted = self.rest[:, :-1] >= tau
        self.depth = posted.sum(axis=1)
        self.held = [np.flatnonzero(posted[:, k]) for k in range(len(self.groups))]
        self.aside = self.whole.copy()
        for rows, g in zip(self.held, self.groups, strict=True):
            self.aside[rows, g] = 0

    def reach(self, queries: np.ndarray, least: np.ndarray) -> Found:
        """(query, row, score) of all pairs that reach the query's threshold. Partial scores are summed
        over the postings, group by group; a pair goes when its partial score and the product of the
        remaining norms cannot reach the threshold any more. Many pairs are summed as a matrix, few one by one."""
        q = queries[:, self.order]
        rest = _remaining(q, self.groups)
        most = rest[:, 0] * self.rest[:, 0].max(initial=0)
        enough = least - 1e-9 * (1 + most)  # norms are rounded
        score = np.zeros((len(q), len(self.whole)))
        alive = rest[:, :1] * self.rest[:, 0] >= enough[:, None]
        k = 0
        while k < len(self.groups) and alive.mean() > FEW:
            rows, g = self.held[k], self.groups[k]
            k += 1
            if len(rows) == len(self.whole):
                score += q[:, g] @ self.whole[:, g].T
                alive &= score + rest[:, k:k + 1] * self.rest[:, k] >= enough[:, None]
            elif len(rows):
                part = score[:, rows] + q[:, g] @ self.whole[rows, g].T
                score[:, rows] = part
                alive[:, rows] &= part + rest[:, k:k + 1] * self.rest[rows, k] >= enough[:, None]
        a, r = np.nonzero(alive)
        found = score[a, r]
        for j in range(k, len(self.groups)):
            g = self.groups[j]
            on = np.flatnonzero(self.depth[r] > j)
            found[on] += np.einsum("ij,ij->i", q[a[on], g], self.whole[r[on], g])
            keep = np.ones(len(a), bool)
            keep[on] = found[on] + rest[a[on], j + 1] * self.rest[r[on], j + 1] >= enough[a[on]]
            a, r, found = a[keep], r[keep], found[keep]
        on = np.flatnonzero(self.depth[r] < len(self.groups))
        for at in range(0, len(on), 1 << 16):
            part = on[at:at + (1 << 16)]
            found[part] += np.einsum("ij,ij->i", q[a[part]], self.aside[r[part]])
        if most.max(initial=0) >= EXACT:
            found = np.einsum("ij,ij->i", q[a].astype(np.int64), self.whole[r].astype(np.int64))
        keep = found >= least[a]
        return a[keep], r[keep], found[keep]


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists as rows of a matrix; shorter ones are filled with zeros."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width))
    out[np.arange(width) < sizes[:, None]] = column.flatten().to_numpy()
    return out


def _ordered(found: Found, ids: np.ndarray, keys: np.ndarray) -> Found:
    """By query, then best score, then smallest id."""
    a, r, s = found
    by = np.lexsort((keys[r], ids[r], -s, a))
    return a[by], r[by], s[by]


def _lowest(least: np.ndarray, q: np.ndarray) -> float:
    """The smallest threshold per norm of the vectors that ask."""
    norms = np.sqrt((q * q).sum(axis=1))
    return float(np.divide(least, norms, out=np.full(len(least), -np.inf), where=norms > 0).min())


def _nearest(q: np.ndarray, own: np.ndarray, x: np.ndarray, ids: np.ndarray, keys: np.ndarray, count: int
             ) -> Iterator[Found]:
    """The ``count`` best rows of each query but itself: the threshold falls until that many reach it."""
    pending = np.arange(len(q))
    norms = np.sqrt((q * q).sum(axis=1))
    longest = np.sqrt((x * x).sum(axis=1).max(initial=0))
    for step in (*POSITIVE_STEPS, None):
        if not len(pending):
            return
        least = np.full(len(pending), -np.inf) if step is None else step * norms[pending] * longest
        a, r, s = Index(x, _lowest(least, q[pending])).reach(q[pending], least)
        other = keys[r] != own[pending[a]]
        a, r, s = _ordered((a[other], r[other], s[other]), ids, keys)
        counts = np.bincount(a, minlength=len(pending))
        full = (counts >= count) | (step is None)
        place = np.arange(len(a)) - (np.cumsum(counts) - counts)[a]
        take = full[a] & (place < count)
        yield pending[a[take]], r[take], s[take]
        pending = pending[~full]


def _within(q: np.ndarray, label: np.ndarray, windows: np.ndarray, x: np.ndarray, labels: np.ndarray,
            ids: np.ndarray, keys: np.ndarray, count: int) -> Iterator[Found]:
    """(window, row, score): the ``count`` best rows of another label in each window (query, low, high). A
    window's threshold starts below its upper end and falls until the window is full, at last to its lower end."""
    pending = np.flatnonzero(windows[:, 1] <= windows[:, 2])
    for step in (*WINDOW_STEPS, 1):
        if not len(pending):
            return
        of, low, high = windows[pending].T
        start = low if step == 1 else high - ((high - low) * step).astype(np.int64)
        asked, at = np.unique(of, return_inverse=True)
        least = np.full(len(asked), np.inf)
        np.minimum.at(least, at, start.astype(float))
        a, r, s = Index(x, _lowest(least, q[asked])).reach(q[asked], least)
        other = labels[r] != label[asked[a]]
        a, r, s = _ordered((a[other], r[other], s[other]), ids, keys)
        bounds = np.searchsorted(a, np.arange(len(asked) + 1))
        full = np.full(len(pending), step == 1)
        down = -s
        for k, (w, lo, hi) in enumerate(zip(at.tolist(), low.tolist(), high.tolist(), strict=True)):
            part = down[bounds[w]:bounds[w + 1]]
            i, j = np.searchsorted(part, -hi, side="left"), np.searchsorted(part, -lo, side="right")
            full[k] |= j - i >= count
            if full[k] and j > i:
                rows = slice(bounds[w] + i, bounds[w] + min(j, i + count))
                yield np.full(rows.stop - rows.start, pending[k]), r[rows], s[rows]
        pending = pending[~full]


def _in_cells(rows: DataFrame, anchors: DataFrame, across: int, down: int,
              search: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``search`` of every block of rows with every block of anchors: a grid of ``across`` x
    ``down`` tasks, to which rows and anchors are dealt by their number."""
    count = across * down
    cells = ["cell_row", "cell_anchor"]
    left = rows.withColumns({
        "cell_row": F.pmod(F.xxhash64("key"), F.lit(across)),
        "cell_anchor": F.explode(F.sequence(F.lit(0), F.lit(down - 1)))})
    right = anchors.withColumns({
        "cell_row": F.explode(F.sequence(F.lit(0).cast("long"), F.lit(across - 1).cast("long"))),
        "cell_anchor": F.pmod(F.xxhash64("key"), F.lit(down)).cast("int")})
    left, right = (x.repartition(count, *cells) for x in (left, right))
    return left.groupBy(*cells).cogroup(right.groupBy(*cells)).applyInArrow(search, schema)


def _blocks(n: int, step: int) -> Iterator[slice]:
    return (slice(at, min(at + step, n)) for at in range(0, n, step))


def mine(df: DataFrame, anchors: Column, id_col: str = "vec_id", label_col: str = "label",
         vector_col: str = "embedding", positives: int = 5, negatives: int = 5, low: int = 80,
         high: int = 100, scale: float = 256) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each anchor and each
    of its ``positives`` best rows of the same label, the ``negatives`` best rows of another label whose score is
    within ``low`` and ``high`` percent of the positive's.

    A score is the inner product of the whole numbers floor(scale * x); components beyond 2^20 count as 2^20. Higher
    scores come first, ties by smaller id, rows without an id last. Rows with a NULL label, a NULL vector or a
    component that is NULL or not finite take no part. Vectors of different lengths are filled with zeros. Rows that
    repeat, or share an id, are rows of their own (an anchor may have its own copy as a positive, and each
    copy of an anchor gets its rows). Where ``anchors`` is NULL, a row is none. An empty table gives no rows;
    further columns are left out.

    Rows and anchors are dealt to a grid of blocks. In each, an inverted index leaves out the dimensions that
    the bound on the remaining norm covers, and thresholds fall until the windows are full (``Index``). Each block passes
    on its best few per window, and these are merged; nothing grows with how many rows are alike. All rows are compared
    with all anchors in the worst case: the work is the product of both."""
    rows = stored(prepared(df, anchors, id_col, label_col, vector_col, scale))
    size = rows.agg(F.count("*").alias("n"), F.count_if("anchor").alias("m"),
                    F.max(F.size("vector")).alias("width")).first()
    width = size["width"] or 0
    session = df.sparkSession
    parallel = int(session.conf.get("spark.sql.shuffle.partitions"))
    per_cell = max(1024, min(1 << 16, CELL_NUMBERS // max(1, width)))
    across = max(1, -(-size["n"] // per_cell), min(parallel, -(-size["n"] // 1024)))
    down = max(1, -(-size["m"] // CELL_ANCHORS))
    asking = rows.where("anchor").drop("anchor")
    rows = rows.drop("anchor")

    def taken(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return (matrix(table["vector"].combine_chunks(), width), table["id"].fill_null(LAST).to_numpy(),
                table["key"].to_numpy())

    def told(out: list[tuple[dict, np.ndarray, np.ndarray]], ids: np.ndarray, keys: np.ndarray,
             names: list[str]) -> pa.Table:
        parts = []
        for own, r, s in out:
            parts.append(pa.table([*[pa.array(own[k]) for k in names], pa.array(
                ids[r], mask=ids[r] == LAST), pa.array(keys[r]), pa.array(s.astype(np.int64))],
                names=[*names, "id", "other", "score"]))
        empty = pa.table({k: pa.array([], pa.int64()) for k in [*names, "id", "other", "score"]})
        return pa.concat_tables([empty, *parts])

    def same(left: pa.Table, right: pa.Table) -> pa.Table:
        (x, ids, keys), (q, _, own) = taken(left), taken(right)
        labels, asked = np.array(left["label"].to_pylist(), object), np.array(right["label"].to_pylist(), object)
        out = []
        for label in sorted(set(asked)):
            mine_, theirs = np.flatnonzero(asked == label), np.flatnonzero(labels == label)
            for b in _blocks(len(theirs), BLOCK_ROWS):
                for c in _blocks(len(mine_), BLOCK_ANCHORS):
                    at, to = mine_[c], theirs[b]
                    out += [({"key": own[at[a]]}, to[r], s) for a, r, s in _nearest(
                        q[at], own[at], x[to], ids[to], keys[to], positives)]
        return told(out, ids, keys, ["key"])

    def different(left: pa.Table, right: pa.Table) -> pa.Table:
        (x, ids, keys), (q, _, own) = taken(left), taken(right)
        labels, asked = np.array(left["label"].to_pylist(), object), np.array(right["label"].to_pylist(), object)
        lists = right["windows"].combine_chunks()
        score = lists.flatten().field("score").to_numpy()
        number = lists.flatten().field("number").to_numpy()
        of = np.repeat(np.arange(len(q)), lists.value_lengths().to_numpy())
        windows = np.column_stack([of, -((-low * score) // 100), high * score // 100])
        out = []
        for b in _blocks(len(x), BLOCK_ROWS):
            for c in _blocks(len(q), BLOCK_ANCHORS):
                held = np.flatnonzero((of >= c.start) & (of < c.stop))
                inside = windows[held] - [c.start, 0, 0]
                for w, r, s in _within(q[c], asked[c], inside, x[b], labels[b], ids[b], keys[b], negatives):
                    w = held[w]
                    out.append(({"key": own[of[w]], "number": number[w]}, r + b.start, s))
        return told(out, ids, keys, ["key", "number"])

    def best(found: DataFrame, groups: list[str], count: int, name: str) -> DataFrame:
        order = Window.partitionBy(*groups).orderBy(F.desc("score"), F.asc_nulls_last("id"), "other")
        return found.withColumn(name, F.row_number().over(order)).where(F.col(name) <= count)

    near = best(_in_cells(rows, asking, across, down, same, "key long, id long, other long, score long"),
                ["key"], positives, "number")
    windows = near.groupBy("key").agg(F.collect_list(F.struct(
        F.col("number").cast("long").alias("number"), "id", "score")).alias("windows"))
    asking = stored(asking.join(windows, "key"))
    far = best(_in_cells(rows, asking, across, down, different,
                         "key long, number long, id long, other long, score long"),
               ["key", "number"], negatives, "rank")
    wanted = asking.select("key", F.col("id").alias("anchor_id"), F.explode("windows").alias("w")).select(
        "key", "anchor_id", F.col("w.number").alias("number"), F.col("w.id").alias("positive_id"),
        F.col("w.score").alias("positive_score"))
    return far.join(wanted, ["key", "number"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))

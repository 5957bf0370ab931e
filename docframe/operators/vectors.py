"""Nearest neighbours: exact for one vector or a whole set, over stored cells, and by signatures."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..functions.vectors import similarity_score
from .clauses import Clause

# Bound on the query vectors or query texts held by each task at once. Larger sets are
# worked off in blocks of this size, so memory per task stays fixed.
QUERY_BLOCK = 2_000


# Scores computed at a time by a task (rows x queries).
SCORE_CELLS = 4_000_000
# Numbers of the vectors that one task of a grid holds.
CELL_NUMBERS = 4_000_000


def best_of_rows():
    """A class keeping the best ``k`` (score, id) of each query within one task. Made in here
    so that it travels to the executors by value."""

    class BestOf:
        def __init__(self, queries: int, k: int, above: float = float("-inf")):
            import numpy as np

            self.k = k
            self.scores = [np.empty(0)] * queries
            self.ids: list = [[] for _ in range(queries)]
            self.bar = np.full(queries, above)  # a row below it cannot be among the best

        def add(self, score, ids) -> None:
            """``score``: rows x queries."""
            import numpy as np

            for j in np.flatnonzero((score >= self.bar).any(axis=0)):
                rows = np.flatnonzero(score[:, j] >= self.bar[j])
                merged = np.concatenate([self.scores[j], score[rows, j]])
                names = self.ids[j] + [ids[i] for i in rows]
                by_id = np.argsort(np.asarray(names), kind="stable")  # ties: the lower id
                top = by_id[np.argsort(-merged[by_id], kind="stable")[: self.k]]
                self.scores[j] = merged[top]
                self.ids[j] = [names[i] for i in top]
                if len(top) == self.k:
                    self.bar[j] = max(self.bar[j], self.scores[j][-1])

        def result(self, qids):
            import numpy as np

            names = [q for q, ids in zip(qids, self.ids) for _ in ids]
            flat = [i for ids in self.ids for i in ids]
            return names, flat, np.concatenate(self.scores)

    return BestOf


def knn(df: DataFrame, field: str, query_vector: list[float], k: int, id: str,
        similarity: str = "cosine", filter: Clause | None = None) -> DataFrame:
    """The ``k`` rows nearest to one vector, with ``_score``. The filter comes first.

    Every row is scored where it is read and each task forwards only its own best ``k``.
    """
    rows = df if filter is None else df.where(filter.pred)
    scored = rows.withColumn("_score", similarity_score(field, list(query_vector), similarity))
    best = scored.orderBy(F.col("_score").desc_nulls_last(), F.col(id).asc()).limit(k)
    return best.where(F.col("_score").isNotNull())  # after the cut: scored once, not twice


def knn_batch(df: DataFrame, field: str, id: str, queries: DataFrame, query_id: str,
              query_vector: str, k: int, similarity: str = "cosine",
              block: int = QUERY_BLOCK) -> DataFrame:
    """The ``k`` nearest rows for every query vector: (query_id, id, _score, rank).

    Up to ``block`` queries (they are counted) go to every task as one matrix; rows are scored where they are read and only
    the best ``k`` per query leave the task. More queries are dealt to a grid of blocks of rows and blocks of
    queries instead, and nothing comes to the driver.
    """
    wanted = queries.select(F.col(query_id).alias("q"), F.col(query_vector).alias("x")).where("x is not null")
    if wanted.limit(block + 1).count() <= block:
        rows = wanted.collect()
        best = _block_best(df, field, id, query_id, rows, wanted.schema["q"].dataType, k, similarity)
    else:
        best = _grid_best(df, field, id, query_id, wanted, k, similarity, block)
    return _merged(best, query_id, id, k)


def _merged(best: DataFrame, query_id: str, id: str, k: int) -> DataFrame:
    w = Window.partitionBy(query_id).orderBy(F.col("_score").desc(), F.col(id).asc())
    return best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _grid_best(df: DataFrame, field: str, id: str, query_id: str, wanted: DataFrame, k: int, similarity: str,
               block: int) -> DataFrame:
    size = df.agg(F.count(field).alias("n"), F.max(F.size(field)).alias("dims")).first()
    across = max(1, -(-size["n"] * (size["dims"] or 1) // CELL_NUMBERS))
    down = -(-wanted.count() // block)
    rows = df.where(F.col(field).isNotNull()).select(F.col(id).alias("_id"), F.col(field).alias("_v")).withColumns({
        "_a": F.pmod(F.xxhash64("_id", "_v"), F.lit(across)),
        "_b": F.explode(F.sequence(F.lit(0).cast("long"), F.lit(down - 1).cast("long")))})
    asked = wanted.withColumns({
        "_a": F.explode(F.sequence(F.lit(0).cast("long"), F.lit(across - 1).cast("long"))),
        "_b": F.pmod(F.xxhash64("q"), F.lit(down))})
    return _groups_best(rows, asked, ["_a", "_b"], id, query_id, k, similarity)


def _groups_best(rows: DataFrame, asked: DataFrame, cells: list[str], id: str, query_id: str, k: int,
                 similarity: str) -> DataFrame:
    """(query_id, id, _score): the best ``k`` rows (_id, _v) for each query (q, x) of the same group."""
    itype, qtype = rows.schema["_id"].dataType, asked.schema["q"].dataType
    arrow_q, arrow_i = to_arrow_type(qtype), to_arrow_type(itype)
    BestOf, scores = best_of_rows(), score_matrix()

    def best_rows(left, right):
        import numpy as np
        import pyarrow as pa

        parts = [pa.table([pa.array([], arrow_q), pa.array([], arrow_i), pa.array([], pa.float64())],
                          names=[query_id, id, "_score"])]
        wide = np.asarray(right["x"].combine_chunks().value_lengths())
        sizes = np.asarray(left["_v"].combine_chunks().value_lengths())
        for dims in np.unique(wide):
            asks, fits = np.flatnonzero(wide == dims), np.flatnonzero(sizes == dims)
            if not len(asks) or not len(fits):
                continue
            q = right["x"].combine_chunks().take(pa.array(asks)).flatten().to_numpy(
                zero_copy_only=False).astype(np.float64).reshape(len(asks), dims)
            best, step = BestOf(len(asks), k), max(1, SCORE_CELLS // len(asks))
            for lo in range(0, len(fits), step):
                some = pa.array(fits[lo: lo + step])
                m = left["_v"].combine_chunks().take(some).flatten().to_numpy(zero_copy_only=False)
                best.add(scores(m.astype(np.float64).reshape(-1, dims), q, similarity),
                         left["_id"].take(some).to_pylist())
            names, ids, found = best.result(right["q"].take(pa.array(asks)).to_pylist())
            parts.append(pa.table([pa.array(names, arrow_q), pa.array(ids, arrow_i), pa.array(found, pa.float64())],
                                  names=[query_id, id, "_score"]))
        return pa.concat_tables(parts)

    return rows.groupBy(*cells).cogroup(asked.groupBy(*cells)).applyInArrow(
        best_rows, f"`{query_id}` {qtype.simpleString()}, `{id}` {itype.simpleString()}, _score double")


def score_matrix():
    """The function (rows, queries, similarity) -> scores, NaN where there is no direction."""

    def scores(m, q, similarity):
        import numpy as np

        prod = m @ q.T
        with np.errstate(divide="ignore", invalid="ignore"):
            if similarity == "cosine":
                length = np.sqrt((m * m).sum(axis=1))
                return (1 + prod / (length[:, None] * np.sqrt((q * q).sum(axis=1))[None, :])) / 2
            if similarity == "dot_product":
                return (1 + prod) / 2
            d = (m * m).sum(axis=1)[:, None] + (q * q).sum(axis=1)[None, :] - 2 * prod
            return 1 / (1 + np.maximum(d, 0))

    return scores


def _block_best(df, field, id, query_id, rows, qtype, k, similarity):
    itype = df.schema[id].dataType
    arrow_q, arrow_i = to_arrow_type(qtype), to_arrow_type(itype)
    qids = [r["q"] for r in rows]
    vectors = [list(r["x"]) for r in rows]

    BestOf, scores = best_of_rows(), score_matrix()

    def best_rows(batches):
        import numpy as np
        import pyarrow as pa

        of = {}  # by dimensions
        for qid, x in zip(qids, vectors, strict=True):
            of.setdefault(len(x), []).append((qid, x))
        groups = [([qid for qid, _ in mine], np.asarray([x for _, x in mine], np.float64).reshape(len(mine), dims),
                   BestOf(len(mine), k)) for dims, mine in of.items()]
        for batch in batches:
            column = batch.column(1)
            sizes = np.asarray(column.value_lengths().fill_null(-1))
            for names, q, best in groups:
                fits, step = np.flatnonzero(sizes == q.shape[1]), max(1, SCORE_CELLS // len(names))
                for lo in range(0, len(fits), step):
                    some = pa.array(fits[lo: lo + step])
                    m = column.take(some).flatten().to_numpy(zero_copy_only=False)
                    score = scores(m.astype(np.float64).reshape(len(some), -1), q, similarity)
                    best.add(score, batch.column(0).take(some).to_pylist())
        for names, _, best in groups:
            found, ids, score = best.result(names)
            if ids:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found, arrow_q), pa.array(ids, arrow_i), pa.array(score, pa.float64())],
                    names=[query_id, id, "_score"],
                )

    return df.select(id, field).mapInArrow(
        best_rows, f"`{query_id}` {qtype.simpleString()}, `{id}` {itype.simpleString()}, _score double"
    )


# ---- cells: approximate search over a stored partition of the vectors -------------------


def fit_cells(df: DataFrame, field: str, cells: int, similarity: str = "cosine", sample: int = 50_000,
              seed: int = 7) -> list[list[float]]:
    """The centres of ``cells`` cells: k-means (``pyspark.ml``) over about ``sample`` vectors, drawn by
    a hash of their content. The sample only places the centres; every vector is stored in a cell."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    length = F.aggregate(F.col(field).cast("array<double>"), F.lit(0.0), lambda a, x: a + x * x)
    known = df.select(F.col(field).cast("array<double>").alias("v"), length.alias("l")).where("l > 0")
    n = known.count()
    drawn = F.pmod(F.xxhash64("v", F.lit(seed)), F.lit(1 << 30)) < int(min(1.0, sample / max(1, n)) * (1 << 30))
    kmeans = KMeans(k=cells, seed=seed, featuresCol="f",
                    distanceMeasure="cosine" if similarity == "cosine" else "euclidean")
    model = kmeans.fit(known.where(drawn).select(array_to_vector("v").alias("f")))
    return [[float(x) for x in c] for c in model.clusterCenters()]


def write_cells(df: DataFrame, path: str, field: str, centres: list[list[float]], similarity: str = "cosine"
                ) -> None:
    """Stores every row with a vector under ``path/rows``, one folder per cell (that of the most similar centre),
    and (cell, centre, n) under ``path/cells``. Rebalancing splits a crowded cell into files by size."""
    scores = score_matrix()

    @F.arrow_udf("int")
    def nearest(vectors):
        import numpy as np
        import pyarrow as pa

        c = np.asarray(centres)
        sizes = np.asarray(vectors.value_lengths().fill_null(-1))
        fits = np.flatnonzero(sizes == c.shape[1])
        m = vectors.take(pa.array(fits)).flatten().to_numpy(zero_copy_only=False)
        found = np.nan_to_num(scores(m.astype(np.float64).reshape(-1, c.shape[1]), c, similarity), nan=-1.0)
        out = np.zeros(len(sizes), np.int32)
        out[fits] = found.argmax(axis=1)
        return pa.array(out, mask=sizes != c.shape[1])

    spark = df.sparkSession
    rows = df.withColumn("cell", nearest(F.col(field))).where("cell is not null")
    rows.hint("rebalance", "cell").write.partitionBy("cell").parquet(f"{path}/rows")
    held = spark.read.parquet(f"{path}/rows").groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    named = spark.createDataFrame(list(enumerate(centres)), "cell int, centre array<double>")
    named.join(held, "cell").write.parquet(f"{path}/cells")


def _probed(centres, sizes, query, num_candidates: int, similarity: str, scores):
    """The places of the most similar centres, until their cells hold ``num_candidates`` rows."""
    import numpy as np

    best = np.nan_to_num(scores(centres, query[None, :], similarity)[:, 0], nan=-1.0)
    order = np.argsort(-best, kind="stable")
    before = np.cumsum(sizes[order]) - sizes[order]
    return order[before < num_candidates]


def _cells(spark, path: str) -> tuple[list[int], list[list[float]], list[int]]:
    """Numbers, centres and sizes: as many as were asked for when the table was made."""
    rows = spark.read.parquet(f"{path}/cells").orderBy("cell").collect()
    return [r["cell"] for r in rows], [r["centre"] for r in rows], [r["n"] for r in rows]


def knn_cells(spark, path: str, field: str, query_vector: list[float], k: int, num_candidates: int, id: str,
              similarity: str = "cosine") -> DataFrame:
    """``knn`` over the nearest cells only, as many as hold ``num_candidates`` rows; the other cells'
    files are not opened. Approximate: a near row in a cell further off is missed."""
    import numpy as np

    cells, centres, sizes = _cells(spark, path)
    places = _probed(np.asarray(centres), np.asarray(sizes), np.asarray(query_vector, float), num_candidates,
                     similarity, score_matrix()) if cells else []
    rows = spark.read.parquet(f"{path}/rows").where(F.col("cell").isin([cells[p] for p in places]))
    return knn(rows, field, query_vector, k, id, similarity)


def knn_cells_batch(spark, path: str, field: str, id: str, queries: DataFrame, query_id: str, query_vector: str,
                    k: int, num_candidates: int, similarity: str = "cosine") -> DataFrame:
    """``knn_cells`` for every query vector: (query_id, id, _score, rank). Queries go to the cells they probe;
    a crowded cell is cut into blocks of rows."""
    cells, centres, sizes = _cells(spark, path)
    wanted = queries.select(F.col(query_id).alias("q"), F.col(query_vector).cast("array<double>").alias("x")).where(
        "x is not null")
    scores, probed = score_matrix(), _probed
    kind = to_arrow_type(wanted.schema["q"].dataType)

    def probe(batches):
        import numpy as np
        import pyarrow as pa

        c, n, names = np.asarray(centres), np.asarray(sizes), np.asarray(cells, np.int32)
        for batch in batches:
            for i in range(batch.num_rows):
                x = np.asarray(batch.column(1)[i].as_py())
                if not len(names) or len(x) != c.shape[1]:
                    continue
                found = names[probed(c, n, x, num_candidates, similarity, scores)]
                one = batch.slice(i, 1).take(pa.array(np.zeros(len(found), np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [one.column(0).cast(kind), one.column(1), pa.array(found)], names=["q", "x", "cell"])

    asked = wanted.mapInArrow(probe, f"q {wanted.schema['q'].dataType.simpleString()}, x array<double>, cell int")
    rows = spark.read.parquet(f"{path}/rows")
    dims = len(centres[0]) if centres else 1
    blocks = {c: max(1, -(-n * dims // CELL_NUMBERS)) for c, n in zip(cells, sizes, strict=True)}
    cut = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in blocks.items() for x in pair]), F.col("cell")),
                     F.lit(1)) if blocks else F.lit(1)
    rows = rows.select("cell", F.col(id).alias("_id"), F.col(field).alias("_v")).withColumn(
        "_b", F.pmod(F.xxhash64("_id", "_v"), cut.cast("long")))
    asked = asked.withColumn("_b", F.explode(F.sequence(F.lit(0).cast("long"), cut.cast("long") - 1)))
    return _merged(_groups_best(rows, asked, ["cell", "_b"], id, query_id, k, similarity), query_id, id, k)


def signature(df: DataFrame, field: str, dims: int, words: int = 4, seed: int = 7,
              name: str = "signature") -> DataFrame:
    """Adds the side of 64·words fixed random hyperplanes each vector lies on, as longs.

    Worth storing: the coarse pass of ``knn_candidates`` then reads only these few bytes.
    """
    planes = _planes(dims, words, seed)

    @F.arrow_udf("array<bigint>")
    def sides(vectors):
        import numpy as np
        import pyarrow as pa

        sizes = np.asarray(vectors.value_lengths().fill_null(-1))
        fits = np.flatnonzero(sizes == dims)
        m = vectors.take(pa.array(fits)).flatten().to_numpy(zero_copy_only=False)
        bits = m.astype(np.float64).reshape(-1, dims) @ planes.T >= 0
        packed = np.packbits(bits.reshape(len(fits), words, 64), axis=2)
        longs = packed.view(">i8").astype("<i8").reshape(-1)
        ends = np.cumsum(np.where(sizes == dims, words, 0)).astype(np.int32)
        offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
        out = pa.ListArray.from_arrays(
            offsets, pa.array(longs), mask=pa.array(sizes != dims))
        return out

    return df.withColumn(name, sides(F.col(field)))


def _planes(dims: int, words: int, seed: int):
    import numpy as np

    return np.random.default_rng(seed).standard_normal((64 * words, dims))


def query_signature(query: list[float], words: int = 4, seed: int = 7) -> list[int]:
    import numpy as np

    bits = _planes(len(query), words, seed) @ np.asarray(query, dtype=np.float64) >= 0
    packed = np.packbits(bits.reshape(words, 64), axis=1)
    return [int(x) for x in packed.copy().view(">i8").reshape(words)]


def knn_candidates(signed: DataFrame, vectors: DataFrame, field: str, query_vector: list[float],
                   k: int, num_candidates: int, id: str, similarity: str = "cosine",
                   words: int = 4, seed: int = 7, name: str = "signature") -> DataFrame:
    """``knn`` with a candidate budget: the ``num_candidates`` rows whose signature differs
    least from the query's are fetched and scored exactly. Approximate by design; ``knn``
    is the exact form. ``signed`` holds (id, signature), ``vectors`` (id, field)."""
    want = query_signature(list(query_vector), words, seed)
    differing = F.lit(0)
    for i, w in enumerate(want):
        differing = differing + F.bit_count(F.get(F.col(name), F.lit(i)).bitwiseXOR(F.lit(w)))
    coarse = (
        signed.where(F.col(name).isNotNull())
        .select(id, differing.alias("_bits")).orderBy("_bits", id).limit(num_candidates)
    )
    fetched = vectors.join(coarse.select(id), id, "left_semi")
    return knn(fetched, field, query_vector, k, id, similarity)


def hybrid(text_hits: DataFrame, id: str, near: DataFrame, near_id: str,
           boost: float = 1.0) -> DataFrame:
    """Text hits with the vector score added where the row is among the ``k`` nearest.

    ``near`` is the result of ``knn``; Spark broadcasts it if its ``k`` rows are few.
    """
    k_rows = near.select(F.col(near_id).alias(id), F.col("_score").alias("_near"))
    return text_hits.join(k_rows, id, "left").withColumn(
        "_score", F.col("_score") + F.coalesce(F.col("_near") * F.lit(float(boost)), F.lit(0.0))
    ).withColumn("near", F.col("_near").isNotNull()).drop("_near")

"""BM25-ranked search.

Only the query's own tokens are counted: one narrow pass over the text gives the corpus
statistics as a single row, a second pass filters and scores. Nothing but that one row is
shuffled, however many documents match. Statistics cover the whole table, whatever is
filtered, and can be computed once and passed in again.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..functions import text as tx
from .clauses import Clause, Term
from .vectors import QUERY_BLOCK, best_of_rows

K1 = 1.2
B = 0.75
# What a task works on at once: documents, and pairs of a document's token and a query that has it.
SLICE_ROWS = 512
SCORE_PAIRS = 1_000_000


def _key(field: str, analyzer: str) -> str:
    return f"{field.replace('.', '__')}__{analyzer}"


def _plan(terms: frozenset[Term]) -> dict[tuple[str, str], list[str]]:
    by_field: dict[tuple[str, str], list[str]] = {}
    for field, analyzer, token in sorted(terms):
        by_field.setdefault((field, analyzer), []).append(token)
    return by_field


def _analysed(df: DataFrame, terms: frozenset[Term]) -> DataFrame:
    """Adds, per field, the token array and then its length and the query tokens in it."""
    plan = _plan(terms)
    df = df.withColumns({
        f"_tok_{_key(f, a)}": tx.ANALYZERS[a](f) for f, a in plan
    })
    return df.withColumns({
        f"_hit_{_key(f, a)}": F.struct(
            F.size(f"_tok_{_key(f, a)}").alias("dl"),
            F.filter(F.col(f"_tok_{_key(f, a)}"), _among(words)).alias("kept"),
        )
        for (f, a), words in plan.items()
    }).drop(*[f"_tok_{_key(f, a)}" for f, a in plan])


def _among(words: list[str]):
    return lambda t: t.isin(*words)


def corpus_stats(df: DataFrame, clause: Clause) -> DataFrame:
    """One row, one struct: documents, total length and document frequency per query token."""
    plan = _plan(clause.terms)
    rows = _analysed(df.select(*{f.split(".")[0] for f, _ in plan}), clause.terms)
    cells = []
    for (f, a), words in plan.items():
        key, hit = _key(f, a), F.col(f"_hit_{_key(f, a)}")
        cells += [
            F.sum((hit["dl"] > 0).cast("long")).alias(f"n_{key}"),
            F.sum(F.when(hit["dl"] > 0, hit["dl"]).cast("long")).alias(f"len_{key}"),
        ]
        cells += [
            F.sum(F.array_contains(hit["kept"], w).cast("long")).alias(f"df_{key}_{i}")
            for i, w in enumerate(words)
        ]
    return rows.agg(*cells).select(F.struct("*").alias("stats"))


class _Context:
    """Hands out the per-term weight Columns to the clauses being scored."""

    def __init__(self, terms: frozenset[Term], stats: Column | None):
        self.plan, self.stats = _plan(terms), stats

    def weight(self, field: str, analyzer: str, token: str) -> Column:
        key = _key(field, analyzer)
        i = self.plan[(field, analyzer)].index(token)
        hit, s = F.col(f"_hit_{key}"), self.stats
        n, freq = s[f"n_{key}"].cast("double"), s[f"df_{key}_{i}"].cast("double")
        mean = s[f"len_{key}"].cast("double") / n
        idf = F.log(F.lit(1.0) + (n - freq + 0.5) / (freq + 0.5))
        tf = F.size(F.filter(hit["kept"], lambda t: t == token)).cast("double")
        damp = F.lit(K1) * (F.lit(1 - B) + F.lit(B) * hit["dl"] / mean)
        weight = idf * tf * F.lit(K1 + 1) / (tf + damp)
        return F.when(tf > 0, weight).otherwise(F.lit(0.0))


def search(df: DataFrame, clause: Clause, scored: bool = False,
           stats: DataFrame | None = None) -> DataFrame:
    """Rows of ``df`` for which ``clause`` holds, with ``_score`` when asked for."""
    hits = df.where(clause.pred)
    if not scored:
        return hits
    if not clause.terms:
        return hits.withColumn("_score", clause.scored(_Context(clause.terms, None)))
    one_row = stats if stats is not None else corpus_stats(df, clause)
    rows = _analysed(hits, clause.terms).withColumn("_stats", one_row.scalar())
    rows = rows.withColumn("_score", clause.scored(_Context(clause.terms, F.col("_stats"))))
    return rows.drop("_stats", *[f"_hit_{_key(f, a)}" for f, a in _plan(clause.terms)])


def max_score(hits: DataFrame) -> DataFrame:
    return hits.agg(F.max("_score").alias("max_score"))


def top_hits(hits: DataFrame, size: int, tie: str) -> DataFrame:
    """The best ``size`` hits; each task keeps only that many."""
    return hits.orderBy(F.col("_score").desc(), F.col(tie).asc()).limit(size)


def batch_search(df: DataFrame, field: str, id: str, queries: DataFrame, query_id: str,
                 query_text: str, k: int, analyzer: str = "standard",
                 block: int = QUERY_BLOCK) -> DataFrame:
    """BM25 for a whole table of query texts: (query_id, id, _score, rank), top ``k`` each.

    Each task holds the distinct tokens of at most ``block`` queries with their weights,
    scores its own documents against them and forwards only its best ``k`` per query. A
    token found in every document and every query thus never becomes a shuffled pair.
    """
    wanted = queries.select(
        F.col(query_id).alias("q"),
        F.array_distinct(tx.ANALYZERS[analyzer](query_text)).alias("words"),
    ).where(F.size("words") > 0)
    pieces = max(1, -(-wanted.count() // block))
    docs = df.select(id, tx.ANALYZERS[analyzer](field).alias("t")).where(F.size("t") > 0)
    best = None
    for b in range(pieces):
        part = wanted if pieces == 1 else wanted.where(
            F.pmod(F.xxhash64("q"), F.lit(pieces)) == b)
        rows = part.collect()
        if rows:
            one = _block_hits(docs, id, query_id, wanted.schema["q"].dataType, rows, k)
            best = one if best is None else best.unionByName(one)
    if best is None:
        return docs.select(
            F.lit(None).cast(wanted.schema["q"].dataType).alias(query_id), id,
            F.lit(0.0).alias("_score"), F.lit(0).alias("rank")).limit(0)
    w = Window.partitionBy(query_id).orderBy(F.col("_score").desc(), F.col(id).asc())
    return best.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _slices(batch):
    return (batch.slice(at, SLICE_ROWS) for at in range(0, batch.num_rows, SLICE_ROWS))


def _block_stats(docs: DataFrame, words: list[str]) -> tuple[int, float, dict[int, int]]:
    """(documents, mean length, documents per word): each task counts the words of the block
    in its own documents and reports one row per word."""
    def count(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        index = pa.array(words)
        df_w = np.zeros(len(words), dtype=np.int64)
        n = total = 0
        for lists in (x.column(0) for batch in batches for x in _slices(batch)):
            dl = np.asarray(lists.value_lengths())
            n += len(dl)
            total += int(dl.sum())
            code = pc.index_in(lists.flatten(), index)
            hit = np.asarray(pc.is_valid(code))
            cell = np.unique(np.repeat(np.arange(len(dl)), dl)[hit] * len(words)
                             + np.asarray(code.drop_null()))
            df_w += np.bincount(cell % len(words), minlength=len(words))
        some = np.flatnonzero(df_w)
        # two more rows carry the number of documents and their total length
        yield pa.RecordBatch.from_arrays([
            pa.array(np.concatenate([some, [-1, -2]]).astype(np.int32)),
            pa.array(np.concatenate([df_w[some], [n, total]])),
        ], names=["w", "c"])

    counts = dict(
        docs.select("t").mapInArrow(count, "w int, c bigint").groupBy("w").agg(F.sum("c")).collect())
    n, total = counts.pop(-1, 0), counts.pop(-2, 0)
    return n, (total / n if n else 1.0), counts


def _block_hits(docs, id, query_id, qtype, rows, k):
    """Best ``k`` documents of each task for one block of queries."""
    qids = [row["q"] for row in rows]
    words = sorted({w for row in rows for w in row["words"]})
    at = {w: i for i, w in enumerate(words)}
    asked = [sorted(at[w] for w in row["words"]) for row in rows]
    arrow_q, arrow_i = to_arrow_type(qtype), to_arrow_type(docs.schema[id].dataType)

    n, mean, found = _block_stats(docs, words)
    idf = [math.log(1 + (n - found.get(i, 0) + 0.5) / (found.get(i, 0) + 0.5))
           for i in range(len(words))]
    k1, b, BestOf = K1, B, best_of_rows()

    def best_rows(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        weight = np.asarray(idf)
        index = pa.array(words)
        # query incidence: which (token, query) pairs there are
        pair_t = np.concatenate([np.asarray(a, dtype=np.int64) for a in asked])
        pair_q = np.repeat(np.arange(len(asked)), [len(a) for a in asked])
        order = np.argsort(pair_t, kind="stable")
        pair_t, pair_q = pair_t[order], pair_q[order]
        start = np.searchsorted(pair_t, np.arange(len(weight) + 1))
        best = BestOf(len(asked), k, above=1e-9)  # no token in common is no hit
        for batch in (x for whole in batches for x in _slices(whole)):
            lists = batch.column(1)
            dl = np.asarray(lists.value_lengths())
            owner = np.repeat(np.arange(len(dl)), dl)
            code = pc.index_in(lists.flatten(), index)
            hit = np.asarray(pc.is_valid(code))
            owner, code = owner[hit], np.asarray(code.drop_null())
            cell, tf = np.unique(owner * len(weight) + code, return_counts=True)
            doc, tok = cell // len(weight), cell % len(weight)
            s = weight[tok] * tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl[doc] / mean))
            ids = batch.column(0).to_pylist()
            # a frequent token meets most queries: blocks are cut by their pairs, too
            pairs = np.bincount(doc, weights=start[tok + 1] - start[tok], minlength=len(dl))
            block = np.cumsum(pairs + len(asked)) // SCORE_PAIRS
            cuts = np.flatnonzero(np.diff(block, prepend=-1, append=np.inf))
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                a, z = np.searchsorted(doc, [lo, hi])
                width = start[tok[a:z] + 1] - start[tok[a:z]]
                row = np.repeat(doc[a:z] - lo, width)
                val = np.repeat(s[a:z], width)
                offs = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
                q = pair_q[np.repeat(start[tok[a:z]], width) + offs]
                score = np.bincount(row * len(asked) + q, weights=val,
                                    minlength=(hi - lo) * len(asked)).reshape(hi - lo, -1)
                score = np.round(score, 9)  # the same whatever order terms were added in
                best.add(score, ids[lo:hi])
        names, found, scores = best.result(qids)
        if found:
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, arrow_q), pa.array(found, arrow_i), pa.array(scores, pa.float64())],
                names=[query_id, id, "_score"])

    return docs.select(id, "t").mapInArrow(
        best_rows,
        f"`{query_id}` {qtype.simpleString()}, "
        f"`{id}` {docs.schema[id].dataType.simpleString()}, _score double",
    )

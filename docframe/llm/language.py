"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import keyed, unit, without

UNKNOWN = "und"
SIZES = (1, 2, 3)
PIECE = 1 << 18
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


@dataclass
class Model:
    languages: list[str]
    log_prior: np.ndarray
    log_prob: np.ndarray = field(repr=False)
    """buckets x languages"""


def lettered(text: str | None) -> bool:
    """Whether a text holds a letter (Unicode categories L*; number signs are none)."""
    return text is not None and any(map(str.isalpha, text))


def n_grams(codes: np.ndarray, bits: int) -> np.ndarray:
    """Bucket numbers of the n-grams of 1 to 3 characters that start at each but the last two
    code points; a row per size."""
    codes = codes.astype(np.uint64) + np.uint64(1)
    count = max(0, len(codes) - max(SIZES) + 1)
    out = np.empty((len(SIZES), count), np.int64)
    mixed = np.zeros(count, np.uint64)
    for k, m in enumerate(MULTIPLIERS):
        mixed = (mixed ^ codes[k:k + count]) * m
        mixed ^= mixed >> np.uint64(29)
        out[k] = (mixed * MULTIPLIERS[0]) >> np.uint64(64 - bits)
    return out


def pieces(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, n-gram starts' code points) blocks of at most about ``PIECE`` characters.
    Texts stand between blanks; a longer text comes in several blocks that overlap by two."""
    pad = max(SIZES) - 1
    rows, block, held = [], [], 0
    for i, text in enumerate(texts):
        if not text:
            continue
        codes = np.frombuffer(f" {text.lower()}{' ' * pad}".encode("utf-32-le", "replace"), np.uint32)
        for at in range(0, len(codes) - pad, PIECE):
            part = codes[at:at + PIECE + pad]
            rows.append((i, len(part) - pad))
            block.append(part)
            held += len(part)
            if held >= PIECE:
                yield np.array(rows), block
                rows, block, held = [], [], 0
    if block:
        yield np.array(rows), block


def _sums(texts: list[str | None], model: Model, bits: int) -> np.ndarray:
    total = np.zeros((len(texts), len(model.languages)))
    for rows, block in pieces(texts):
        ids = np.concatenate([n_grams(part, bits) for part in block], axis=1)
        starts = np.concatenate([[0], np.cumsum(rows[:, 1])[:-1]])
        for of_size in ids:
            np.add.at(total, rows[:, 0], np.add.reduceat(
                model.log_prob[of_size], starts, axis=0, dtype=np.float64))
    return total


def fit(df: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
        per_language: int = 4000, bits: int = 16, max_languages: int = 200, smoothing: float = 0.5,
        seed: str = "language") -> Model:
    """Learns from the rows whose text and language are not NULL.

    The sample is bounded: about ``per_language`` whole documents of each language (all of a
    language that has fewer), chosen by a hash of the id. Priors count all rows. The model
    holds 2^bits x languages numbers, whatever the table's size; more than ``max_languages``
    languages are refused. An empty table gives a model without languages."""
    known = df.where(F.col(f"`{text_col}`").isNotNull() & F.col(f"`{lang_col}`").isNotNull()).select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"),
        F.col(f"`{lang_col}`").cast("string").alias("lang"))
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(
        F.count("*").alias("n")).limit(max_languages + 1).collect()}
    if len(sizes) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros(0), np.zeros((1 << bits, 0), np.float32))
    share = F.create_map(*[F.lit(x) for lang in languages for x in (
        lang, per_language / sizes[lang])])
    sample = known.where(unit(keyed(F.lit(seed), "id")) < share[F.col("lang")])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {lang: np.zeros(1 << bits, np.int64) for lang in languages}
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for rows, block in pieces(batch.column("text").to_pylist()):
                for (row, _), part in zip(rows, block, strict=True):
                    held[langs[row]] += np.bincount(
                        n_grams(part, bits).ravel(), minlength=1 << bits)
        for lang, found in held.items():
            at = np.flatnonzero(found)
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(at)), pa.array(at), pa.array(found[at])],
                    names=["lang", "bucket", "n"])

    counts = sample.select("lang", "text").mapInArrow(
        count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(
        F.sum("n").alias("n")).toArrow()
    table = np.full((1 << bits, len(languages)), smoothing)
    if counts.num_rows:
        place = {lang: k for k, lang in enumerate(languages)}
        columns = np.array([place[x] for x in counts.column("lang").to_pylist()])
        table[counts.column("bucket").to_numpy(), columns] += counts.column("n").to_numpy()
    prior = np.array([sizes[lang] for lang in languages], float)
    return Model(languages, np.log(prior / prior.sum()),
                 np.log(table / table.sum(axis=0)).astype(np.float32))


def identify(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Every row with ``lang_pred`` and ``score``, the posterior probability of that language.

    Texts that are NULL or hold no letter, and all texts if the model knows no language, get
    ``und`` and 0. Ties go to the language that sorts first. Whole texts are scored, in blocks,
    so a very long one needs no more memory than its characters. Only the text is looked at;
    columns named lang_pred or score are replaced, other extra columns pass through."""
    df = without(df, "lang_pred", "score")
    shared = df.sparkSession.sparkContext.broadcast(model)
    bits = int(model.log_prob.shape[0]).bit_length() - 1

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        names = np.array([*own.languages, UNKNOWN], object)
        for batch in batches:
            texts = batch.column(text_col).to_pylist()
            told = np.array([lettered(t) for t in texts], bool)
            best, sure = np.full(len(texts), len(own.languages)), np.zeros(len(texts))
            if own.languages and len(texts):
                sums = _sums(texts, own, bits) + own.log_prior
                odds = np.exp(sums - sums.max(axis=1, keepdims=True))
                best = np.where(told, sums.argmax(axis=1), best)
                sure = np.where(told, 1 / odds.sum(axis=1), sure)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names[best].tolist(), pa.string()), pa.array(sure)],
                names=[*batch.schema.names, "lang_pred", "score"])

    schema = T.StructType([*df.schema.fields, T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    return df.mapInArrow(score, schema)


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is left for testing: crc32 of its id as text is 2 modulo 4. A NULL id
    counts as empty text."""
    text = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 4 == 2

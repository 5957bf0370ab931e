"""Quality rules as weak supervision: rules vote or abstain, their accuracies are estimated by
expectation-maximisation, and the posterior probability of good quality decides."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, free_name, in_words, let, without

SYMBOLS = "[#*$%&|<>]"
UPPER = "[A-Z]"
SHOUTS = "[!?]"
WORD = r"[^\x20\x09-\x0D]"
WINDOW = 5
ENDED = r"[.!?\"\u2026\u201D][\x20\x09\x0B-\x0D]*+(?=\n|\z)"
LETTERLESS = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D\p{L}]++(?![^\x20\x09-\x0D])"
PRIOR = 0.85
FIRED_IF_BAD, FIRED_IF_GOOD = 0.3, 0.01
PRAISED_IF_BAD, PRAISED_IF_GOOD = 0.3, 0.8
WEIGHT = 20.0
"""What the starting rates count for, in documents."""


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """How many words lie in windows of ``window`` words that the array holds twice or more.
    Windows are compared by 64-bit hashes; only texts that hold a repeat are sorted."""

    def covered(hashes: Column) -> Column:
        placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def twice(s: Column) -> Column:
            alike = F.filter(s, lambda x, j: (F.get(s, j - 1)["h"] == x["h"]) | (
                F.get(s, j + 1)["h"] == x["h"]))
            return F.array_sort(F.transform(alike, lambda x: x["i"]))

        def length(p: Column) -> Column:
            steps = F.transform(p, lambda x, j: F.least(
                F.lit(window), F.coalesce(F.get(p, j + 1) - x, F.lit(window))))
            return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

        return let(let(placed, twice), length)

    def count(h: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(0), F.size(h) - window),
            lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(window)]))
        return let(windows, lambda w: F.when(
            F.size(F.array_distinct(w)) < F.size(w), covered(w)).otherwise(0))

    return F.when(F.size(words) <= window, F.lit(0).cast("long")).otherwise(
        let(F.transform(words, lambda w: F.xxhash64(w)), count)).cast("long")


def measures(text: Column) -> Column:
    """The text's counts as one struct, all worked out from the whole text; NULL counts as
    empty. ``n_lines`` are lines with a word, ``n_dup_lines`` those equal to an earlier one, ``n_ended``
    lines whose last sign ends a sentence, ``n_letterless`` words without any letter."""

    def line_counts(lines: Column) -> Column:
        return F.struct(F.size(lines).cast("long").alias("lines"), (
            F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("dup"))

    def counts(t: Column) -> Column:
        lines = let(F.filter(F.split(t, "\n", -1), lambda x: x.rlike(WORD)), line_counts)
        of_words = let(in_words(t), lambda w: F.struct(
            F.size(w).cast("long").alias("n"),
            F.aggregate(w, F.lit(0).cast("long"), lambda a, x: a + F.char_length(x)).alias("chars"),
            repeated_words(w).alias("repeat")))
        return let(F.struct(lines.alias("l"), of_words.alias("w")), lambda x: F.struct(
            x["w"]["n"].alias("n_words"), x["w"]["chars"].alias("word_chars"),
            _count(t, SYMBOLS).alias("n_symbols"), x["l"]["dup"].alias("n_dup_lines"),
            x["w"]["repeat"].alias("n_repeat_words"), x["l"]["lines"].alias("n_lines"),
            _count(t, UPPER).alias("n_upper"), _count(t, SHOUTS).alias("n_shouts"),
            _count(t, ENDED).alias("n_ended"), _count(t, LETTERLESS).alias("n_letterless"),
        ))

    return let(F.coalesce(text, F.lit("")), counts)


def default_rules() -> dict[str, tuple[Column, Column]]:
    """Rule name -> (votes bad, votes good) on the measures; neither is to abstain."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    mean = F.col("word_chars") / words
    symbols = F.col("n_symbols") / words
    dup = F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))
    repeat = F.col("n_repeat_words") / words
    upper = F.col("n_upper") / F.greatest(F.col("word_chars"), F.lit(1))
    shouts = F.col("n_shouts") / words
    ended = F.col("n_ended") / F.greatest(F.col("n_lines"), F.lit(1))
    letterless = F.col("n_letterless") / words
    never = F.lit(False)
    return {
        "word_length": ((mean < 3) | (mean > 12), (mean >= 3.5) & (mean <= 9)),
        "symbols": (symbols > 0.1, symbols < 0.02),
        "dup_lines": ((dup > 0.3) & (F.col("n_dup_lines") >= 3), dup < 0.05),
        "repeat_words": (repeat > 0.2, repeat < 0.05),
        "upper": (upper > 0.3, upper < 0.1),
        "shouts": (shouts > 0.1, shouts < 0.03),
        "size": (never, F.col("n_words").between(30, 100_000)),
        "line_ends": (ended < 0.9, ended >= 0.97),
        "letterless": (letterless > 0.1, letterless < 0.02),
    }


def votes(rules: dict[str, tuple[Column, Column]]) -> Column:
    """One vote per rule: -1 bad, 1 good, 0 abstains."""
    return F.array(*[F.when(bad, -1).when(good, 1).otherwise(0) for bad, good in rules.values()])


def accuracies(patterns: DataFrame, n_rules: int, rounds: int = 30) -> DataFrame:
    """One row: per rule ``fired`` and ``praised``, the log odds that its bad and its good vote lend
    to good quality. Estimated from (votes, n) by expectation-maximisation; at most 3^rules
    patterns meet in the one row.

    Two classes; given the class, rules vote independently, each with its own free rates of bad and
    good votes in either class. A rule whose bad votes fall on both classes alike is left with a
    weight near 0, whatever it was meant to find. The rates start where rules are mostly right, which
    names the classes; the start counts for ``WEIGHT`` documents, so no rate is 0. Abstaining says nothing, and
    the share of good documents is a parameter (``PRIOR``)."""
    rows = patterns.agg(F.array_sort(F.collect_list(F.struct("votes", "n"))).alias("p"))
    none = F.array_repeat(F.lit(0.0), n_rules)

    def log_odds(in_good: Column, good: Column, in_bad: Column, bad: Column,
                 start_good: float, start_bad: float) -> Column:
        return F.zip_with(in_good, in_bad, lambda g, b: F.log(
            (g + WEIGHT * start_good) / (good + WEIGHT) * (bad + WEIGHT) / (b + WEIGHT * start_bad)))

    def improve(s: Column, p: Column) -> Column:
        judged = F.transform(p, lambda x: F.struct(
            x["votes"].alias("votes"), x["n"].cast("double").alias("n"),
            posterior(x["votes"], s).alias("good")))
        zero = F.struct(F.lit(0.0).alias("good"), F.lit(0.0).alias("bad"),
                        none.alias("fg"), none.alias("fb"), none.alias("pg"), none.alias("pb"))

        def add(held: Column, x: Column, vote: int, mass: Column) -> Column:
            return F.zip_with(held, x["votes"], lambda h, v: h + F.when(v == vote, mass).otherwise(0.0))

        summed = F.aggregate(judged, zero, lambda a, x: let(F.struct(
            (x["n"] * x["good"]).alias("g"), (x["n"] * (1 - x["good"])).alias("b")),
            lambda m: F.struct(
                (a["good"] + m["g"]).alias("good"), (a["bad"] + m["b"]).alias("bad"),
                add(a["fg"], x, -1, m["g"]).alias("fg"), add(a["fb"], x, -1, m["b"]).alias("fb"),
                add(a["pg"], x, 1, m["g"]).alias("pg"), add(a["pb"], x, 1, m["b"]).alias("pb"))))
        return let(summed, lambda t: F.struct(
            log_odds(t["fg"], t["good"], t["fb"], t["bad"], FIRED_IF_GOOD, FIRED_IF_BAD).alias("fired"),
            log_odds(t["pg"], t["good"], t["pb"], t["bad"], PRAISED_IF_GOOD, PRAISED_IF_BAD)
            .alias("praised")))

    start = F.struct(
        F.array_repeat(F.lit(math.log(FIRED_IF_GOOD / FIRED_IF_BAD)), n_rules).alias("fired"),
        F.array_repeat(F.lit(math.log(PRAISED_IF_GOOD / PRAISED_IF_BAD)), n_rules).alias("praised"))
    return rows.select(F.aggregate(
        F.sequence(F.lit(1), F.lit(rounds)), start,
        lambda s, _: improve(s, F.col("p"))).alias("s")).select("s.*")


def posterior(cast: Column, model: Column) -> Column:
    """The probability of good quality given the votes cast and a row of ``accuracies``."""
    weights = F.arrays_zip(model["fired"].alias("f"), model["praised"].alias("p"))
    odds = F.aggregate(
        F.zip_with(cast, weights,
                   lambda v, w: F.when(v == -1, w["f"]).when(v == 1, w["p"]).otherwise(0.0)),
        F.lit(math.log(PRIOR / (1 - PRIOR))), lambda a, x: a + x)
    return 1 / (1 + F.exp(-odds))


def judge(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          rules: dict[str, tuple[Column, Column]] | None = None, threshold: float = 0.65,
          rounds: int = 30) -> DataFrame:
    """(id, measures, ``base_failed``, ``votes``, ``good``, ``kept``) of every row.

    ``base_failed`` texts, of under 10 words or with over a fifth of their words in repeated
    windows of five, are not kept; of the rest those whose posterior probability of good quality is
    at least ``threshold`` are. The rates are estimated from the votes on all texts that do not fail the
    base, and all rows get a posterior. A NULL or empty text has no words and fails;
    repeated rows and a NULL id get a row each; an empty table gives none. Only the two named columns
    are read, so others may have any name."""
    rules = rules or default_rules()
    rows = df.select(F.col(f"`{id_col}`").alias(id_col), measures(F.col(f"`{text_col}`")).alias("m"))
    rows = rows.select(id_col, "m.*")
    voted = cut(rows.withColumn("votes", votes(rules)))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    patterns = voted.where(~failed).groupBy("votes").agg(F.count("*").alias("n"))
    model = accuracies(patterns, len(rules), rounds)
    # one row
    scored = voted.join(F.broadcast(model.select(F.struct("*").alias("model"))))
    scored = scored.withColumn("good", posterior(F.col("votes"), F.col("model")))
    return scored.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("good") >= threshold)).drop("model")


def keep_good(df: DataFrame, **options) -> DataFrame:
    """The rows of ``df`` that ``judge`` keeps, unchanged. Rows alike in id and text share their
    judgement."""
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    row = free_name(df, "_row")
    tagged = df.withColumn(row, F.xxhash64(f"`{id_col}`", f"`{text_col}`"))
    good = judge(tagged.select(F.col(row).alias("id"), F.col(f"`{text_col}`").alias("text")),
                 **options | {"id_col": "id", "text_col": "text"})
    good = good.where("kept").select(F.col("id").alias(row)).distinct()
    return without(tagged.join(good, row, "left_semi"), row)

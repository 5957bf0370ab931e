"""Text analysis as Column expressions.

``tokens`` stays inside whole-stage code generation (split, array_remove), so it is the
only analysis step used in hot filters; the English analyser adds one lambda per token.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD_BREAK = r"[^\p{L}\p{N}]+"

# The common English stop words.
STOP_WORDS = (
    "a an and are as at be but by for if in into is it no not of on or such that the "
    "their then there these they this to was will with"
).split()


def col(field: str | Column) -> Column:
    return F.col(field) if isinstance(field, str) else field


def tokens(field: str | Column) -> Column:
    """Lower-cased runs of letters and digits, in order."""
    return F.array_remove(F.split(F.lower(col(field)), WORD_BREAK), "")


def stem(t: Column) -> Column:
    """Plural rules of Harman's S-stemmer, then -ing / -ed when a vowel is left."""

    def drop(c: Column, n: int) -> Column:
        return F.substr(c, F.lit(1), F.length(c) - F.lit(n))

    def ends(c: Column, *suffixes: str) -> Column:
        out = c.endswith(suffixes[0])
        for s in suffixes[1:]:
            out = out | c.endswith(s)
        return out

    plural = (
        F.when(ends(t, "ies") & ~ends(t, "eies", "aies"), F.concat(drop(t, 3), F.lit("y")))
        .when(ends(t, "es") & ~ends(t, "aes", "ees", "oes"), drop(t, 1))
        .when(ends(t, "s") & ~ends(t, "us", "ss"), drop(t, 1))
        .otherwise(t)
    )
    return (
        F.when(plural.rlike("[aeiouy].*ing$"), drop(plural, 3))
        .when(plural.rlike("[aeiouy].*ed$"), drop(plural, 2))
        .otherwise(plural)
    )


def english(field: str | Column) -> Column:
    """Standard tokens without stop words, stemmed."""
    kept = F.filter(tokens(field), lambda t: ~t.isin(*STOP_WORDS))
    return F.transform(kept, stem)


def keyword(field: str | Column) -> Column:
    """The whole value as a single token."""
    c = col(field).cast("string")
    return F.when(c.isNotNull(), F.array(c))


def normalise(field: str | Column) -> Column:
    return F.lower(F.trim(col(field)))


def ngrams(field: str | Column, low: int, high: int) -> Column:
    """Every substring of ``low``..``high`` characters of a (short) keyword."""
    c = F.lower(col(field))
    sizes = F.sequence(F.lit(low), F.lit(high))

    def of_size(n: Column) -> Column:
        starts = F.when(F.length(c) >= n, F.sequence(F.lit(1), F.length(c) - n + 1))
        return F.coalesce(
            F.transform(starts, lambda i: F.substring(c, i, n)), F.array().cast("array<string>")
        )

    return F.flatten(F.transform(sizes, of_size))


def edge_ngrams(field: str | Column, low: int, high: int) -> Column:
    """Leading substrings, for prefix suggestions."""
    c = F.lower(col(field))
    top = F.least(F.lit(high), F.length(c))
    return F.when(
        top >= low, F.transform(F.sequence(F.lit(low), top), lambda n: F.substring(c, F.lit(1), n))
    ).otherwise(F.array().cast("array<string>"))


ANALYZERS: dict[str, Callable[[str | Column], Column]] = {
    "standard": tokens,
    "english": english,
    "keyword": keyword,
}


def analyse_query(text: str, analyzer: str = "standard") -> list[str]:
    """The tokens of a (short) query string, by the same rules as the column analysers."""
    if analyzer == "keyword":
        return [text]
    words = [w for w in re.split(r"[\W_]+", text.lower()) if w]
    if analyzer == "standard":
        return words
    out = []
    for w in words:
        if w in STOP_WORDS:
            continue
        if w.endswith("ies") and not w.endswith(("eies", "aies")):
            w = w[:-3] + "y"
        elif w.endswith("es") and not w.endswith(("aes", "ees", "oes")):
            w = w[:-1]
        elif w.endswith("s") and not w.endswith(("us", "ss")):
            w = w[:-1]
        if re.search("[aeiouy].*ing$", w):
            w = w[:-3]
        elif re.search("[aeiouy].*ed$", w):
            w = w[:-2]
        out.append(w)
    return out

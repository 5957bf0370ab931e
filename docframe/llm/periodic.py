"""Periodic run detection: maximal pairs from a bottom-up walk of the LCP-interval tree."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import without

BLOCK = 1 << 20
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words ``[^\\x20\\x09-\\x0D]+`` of the texts in a row, and where each text's words start
    (one more number than texts). NULL has no words."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat, ends = lists.flatten(), np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(
        zero_copy_only=False))]).astype(np.int64)
    full = pc.not_equal(flat, "")
    held = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    return flat.filter(full), held[ends]


def least_lcp(min_length: int, min_exponent: int) -> int:
    """The shortest common prefix that two places of a run that counts can have."""
    return min(max(min_length - q, (min_exponent - 1) * q) for q in range(1, min_length + 1))


def _ranks(values: np.ndarray) -> np.ndarray:
    return np.unique(values, return_inverse=True)[1].astype(np.int64)


def suffixes(words: np.ndarray, starts: np.ndarray, first: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """The places whose next ``first`` words (2 or 4) come again in the same text, in the order of (text, suffix), and
    the number of words that each has in common with the place before it (0 with one of another
    text). Prefix doubling over all texts at once; places that are already alone drop out. A
    level takes four bytes a word, and there are as many levels as the logarithm of the longest
    repeat."""
    n = len(words)
    text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    end = starts[1:][text]
    at = np.arange(n)

    def ahead(rank: np.ndarray, places: np.ndarray, h: int) -> np.ndarray:
        """1 + the rank ``h`` words on, 0 beyond the text's end."""
        on = places + h
        return np.where(on < end[places], rank[np.minimum(on, n - 1)] + 1, 0)

    levels = [words.astype(np.int64)]
    for h in (1, 2)[:first // 2]:
        last = levels[-1]
        levels.append(_ranks(last * (n + 2) + ahead(last, at, h)))
    key = text * (n + 1) + levels[-1]
    order = np.argsort(key, kind="stable")
    new = np.concatenate([[True], np.diff(key[order]) != 0])
    heads = np.flatnonzero(new)
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(heads, np.diff(np.append(heads, n)))
    levels = [x.astype(np.int32) for x in (*levels[:-1], rank)]

    def shared(sorted_rank: np.ndarray) -> np.ndarray:
        same = np.concatenate([[False], np.diff(sorted_rank) == 0])
        return same | np.append(same[1:], False)

    order = order[shared(rank[order])]
    active, h = order, first
    while len(active):
        key = rank[active] * (n + 2) + ahead(rank, active, h)
        by = np.argsort(key, kind="stable")
        active, key = active[by], key[by]
        old = rank[active]
        place = np.arange(len(active))
        first = np.maximum.accumulate(np.where(np.concatenate([[True], np.diff(old) != 0]), place, 0))
        head = np.maximum.accumulate(np.where(np.concatenate([[True], np.diff(key) != 0]), place, 0))
        rank = rank.copy()
        rank[active] = old + head - first
        active = active[shared(rank[active])]
        h *= 2
        levels.append(rank.astype(np.int32))
    order = order[np.argsort(rank[order], kind="stable")]
    a, b = order[:-1], order[1:]
    off = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x, y = a + off, b + off
        inside = (x < end[a]) & (y < end[b]) & (text[a] == text[b])
        x, y = np.minimum(x, n - 1), np.minimum(y, n - 1)
        off += np.where(inside & (levels[k][x] == levels[k][y]), 1 << k, 0)
    return order, np.concatenate([[0], off]) if len(order) else off


def maximal_pairs(order: np.ndarray, lcp: np.ndarray, left: np.ndarray, min_length: int,
                  min_exponent: int) -> Iterator[tuple[int, int, int]]:
    """(start, length, period) of every run, from the suffixes in order.

    A run with period q that starts at i and is L words long is a maximal pair: i and i + q have just L - q
    words in common and different words to their left. The walk closes the intervals of the LCP
    tree from the deepest up. An interval's left-word classes are held as one list in order of place, each place
    with its left word (``left``, -1 at a text's start), and the shorter child is merged into the
    longer. As L - q is at least 2q, no further occurrence lies between i and i + q (else the run had a smaller
    period), so a pair of neighbours from different children, of different classes and close enough is a
    run with its smallest period, and every run is such a pair."""
    least = least_lcp(min_length, min_exponent)
    stack: list[tuple[int, list[int]]] = []

    def merge(a: list[int], b: list[int], common: int) -> list[int]:
        if len(a) < len(b):
            a, b = b, a
        for p in b:
            insort(a, p)
        own = set(b) if len(b) > 1 else b
        most = common // (min_exponent - 1)
        for p in b:
            k = bisect_left(a, p)
            for i, j in ((k - 1, k), (k, k + 1)):
                if i < 0 or j == len(a):
                    continue
                x, y = a[i], a[j]
                q = y - x
                if (q <= most and common + q >= min_length and left[x] != left[y]
                        and (y if x == p else x) not in own):
                    found.append((x, common + q, q))
        return a

    found: list[tuple[int, int, int]] = []
    left = left.tolist()
    places = order.tolist()
    for i, common in enumerate([*lcp[1:].tolist(), 0]):
        child = [places[i]]
        while stack and stack[-1][0] > common:
            depth, held = stack.pop()
            child = merge(held, child, depth)
        if common >= least:
            if stack and stack[-1][0] == common:
                depth, held = stack.pop()
                child = merge(held, child, depth)
            stack.append((common, child))
        if found:
            yield from found
            found.clear()


def runs_of(words: np.ndarray, starts: np.ndarray, min_length: int, min_exponent: int) -> np.ndarray:
    """Rows (text, start, length, period), sorted; ``words`` are numbers, texts start at ``starts``."""
    if not len(words):
        return np.zeros((0, 4), np.int64)
    least = least_lcp(min_length, min_exponent)
    order, lcp = suffixes(words, starts, 4 if least >= 4 else 2)
    # only stretches of neighbours with enough in common take part
    deep = lcp >= least
    kept = deep | np.append(deep[1:], False)
    lcp = np.where(deep, lcp, 0)
    left = np.concatenate([[-1], words[:-1]])
    left[starts[:-1][starts[:-1] < len(words)]] = -1
    found = np.array(list(maximal_pairs(order[kept], lcp[kept], left, min_length, min_exponent))
                     if kept.any() else [], np.int64).reshape(-1, 3)
    text = np.searchsorted(starts, found[:, 0], side="right") - 1
    out = np.column_stack([text, found[:, 0] - starts[text], found[:, 1:]])
    return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]


def _blocks(texts: pa.Array) -> Iterator[pa.Array]:
    """The texts in blocks of about ``BLOCK`` bytes; a longer text is a block by itself."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        before = sizes[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(sizes, before + BLOCK, side="right")))
        yield texts.slice(at, to - at)
        at = to


def find_runs(df: DataFrame, text_col: str = "text", min_length: int = 6, min_exponent: int = 4
              ) -> DataFrame:
    """Every row with ``n_words``, ``runs`` (start, length and period in words, by start and then
    period) and ``collapsed`` (the words that are left when each run keeps its first period, joined by
    a blank).

    A run is a stretch of words with smallest period q that no neighbouring word extends, at least
    ``min_length`` words and ``min_exponent`` (3 or more) periods long. Texts are searched whole and each by itself,
    many small ones in one go. A text that is NULL, empty or blank has no words and no runs and collapses to an empty
    text. Rows count one by one, repeated ones and those with the same or no id too; an empty table stays
    empty. Other columns pass through; ones named like an added column are replaced."""
    if min_exponent < 3 or min_length < 2:
        raise ValueError("a run has at least three periods and two words")
    df = without(df, "n_words", "runs", "collapsed")
    run = pa.struct([(k, pa.int64()) for k in ("start", "length", "period")])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, at = batch.column(text_col), 0
            for block in _blocks(texts):
                words, starts = split_words(block)
                found = runs_of(words.dictionary_encode().indices.to_numpy().astype(np.int64), starts,
                                min_length, min_exponent)
                depth = np.zeros(len(words) + 1, np.int64)
                first = starts[found[:, 0]] + found[:, 1]
                np.add.at(depth, first + found[:, 3], 1)
                np.add.at(depth, first + found[:, 2], -1)
                stays = np.cumsum(depth[:-1]) == 0
                ends = np.concatenate([[0], np.cumsum(stays)])[starts]
                kept = pa.ListArray.from_arrays(
                    pa.array(ends, pa.int32()), words.filter(pa.array(stays)))
                per_text = np.searchsorted(found[:, 0], np.arange(len(starts)))
                runs = pa.ListArray.from_arrays(pa.array(per_text, pa.int32()), pa.StructArray.from_arrays(
                    [pa.array(found[:, k]) for k in (1, 2, 3)], fields=list(run)))
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(at, len(block)).columns, pa.array(np.diff(starts)), runs,
                     pc.binary_join(kept, " ")],
                    names=[*batch.schema.names, "n_words", "runs", "collapsed"])
                at += len(block)

    added = T._parse_datatype_string(f"n_words long, runs {RUNS}, collapsed string")
    return df.mapInArrow(search, T.StructType([*df.schema.fields, *added.fields]))

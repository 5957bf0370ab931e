"""Benchmark decontamination: CGK embedding, bit-sampling LSH and exact edit verification."""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import free_name, without
from .neardup import GAMMA, mixed

TARGET = 0.95
SAMPLES = 4
MOST_REPEATS = 24
PAIRS, SHIFT = 120, 2
REACH = 1.6
VOCABULARY_BITS = 22
PIECE = 1 << 18
_BREAKS = bytes(0x20 if c < 0x80 and not chr(c).isalnum() else
                c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))


def tokens(text: str | None) -> np.ndarray:
    """64-bit hashes of the words: runs of letters, digits and non-ASCII characters, A to Z in
    lower case."""
    words = (text or "").encode("utf-8", "replace").translate(_BREAKS).split()
    out = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    out[out == 0] = 1
    return out


def _sizes(n: int) -> int:
    """The window size of an item or piece of ``n`` words: the largest step of the series 1, 2, 3, 4, 5, 6,
    8, 10, 13, 16, 20, ... (steps of a quarter) that does not exceed it."""
    size = 1
    while max(size + 1, size * 5 // 4) <= n:
        size = max(size + 1, size * 5 // 4)
    return size


def _most(rate: float, n: int) -> int:
    return int(rate * n + 1e-9)


def cuts(n: int, edits: int) -> list[tuple[int, int]]:
    """(offset, window size) of the pieces of an item of ``n`` words, one more than it may have edits:
    whichever words are edited, one piece stays as it is."""
    count = min(edits, n - 1) + 1
    bounds = [n * k // count for k in range(count + 1)]
    return [(a, _sizes(b - a)) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def _steps(size: int) -> int:
    return max(1, math.ceil(REACH * size))


def _drawn(size: int, repeat: int, count: int) -> list[int]:
    """Steps of the walk, drawn without putting back; fewer of them are the first of more."""
    order = np.argsort(mixed(np.arange(_steps(size), dtype=np.uint64) * GAMMA
                             + np.uint64(size + 7919 * repeat)))
    return order[:count].tolist()


def samples(size: int, repeat: int, count: int) -> list[int]:
    """The steps of the walk whose symbols make up a repeat's key, in order."""
    return sorted(_drawn(size, repeat, count))


def _moves(words: np.ndarray, step: int, repeat: int | np.ndarray) -> np.ndarray:
    """The random bits of (step, word) in a repeat: whether the pointer moves on."""
    salt = np.uint64((step + 1) * 2654435761) + np.asarray(repeat).astype(np.uint64) * np.uint64(0x9E3779B1)
    return (mixed(words + salt) >> np.uint64(63)).astype(np.int64)


@functools.cache
def repeats_for(size: int, edits: int, target: float) -> tuple[int, int]:
    """(symbols per key, repeats) at which a window of ``size`` words and its copy with ``edits`` edits
    share a key with probability ``target``.

    Measured by taking ``PAIRS`` random windows and edited copies through the repeats themselves (fixed seed,
    all words different, edits foreign to the items). Windows start at every word, so those up to ``SHIFT``
    words off count too. Most symbols are taken that need no more than ``MOST_REPEATS`` repeats;
    where one symbol needs more, the repeats end there (the pieces find the rest)."""
    if edits == 0:
        return SAMPLES, 1
    rng = np.random.default_rng([size, edits])

    def some(n: int, foreign: int = 1) -> list[int]:
        return (rng.integers(1, 1 << 63, n, dtype=np.uint64) | np.uint64(foreign << 63)).tolist()

    item = np.zeros((PAIRS, size + 1), np.uint64)
    text = np.zeros((PAIRS, size + 2 * SHIFT), np.uint64)
    for k in range(PAIRS):
        own = some(size, 0)
        item[k, :size] = own
        for _ in range(edits):
            kind, at = rng.integers(3), int(rng.integers(max(1, len(own))))
            own[at:at + int(kind != 0)] = some(int(kind != 1))
        text[k] = [*some(SHIFT), *own, *some(size)][:size + 2 * SHIFT]
    row, walk = (x.ravel() for x in np.indices((PAIRS, MOST_REPEATS)))
    drawn = np.array([_drawn(size, r + 1, SAMPLES) for r in range(MOST_REPEATS)])
    end = np.zeros((PAIRS, 1), np.uint64)
    sides = [item, *[np.concatenate([text[:, k:k + size], end], axis=1) for k in range(2 * SHIFT + 1)]]
    offs = [np.zeros(len(row), np.int64) for _ in sides]
    agreed = np.zeros((drawn.shape[1], len(sides) - 1, len(row)), bool)
    for step in range(drawn.max() + 1):
        words = [x[row, np.minimum(off, size)] for x, off in zip(sides, offs, strict=True)]
        for j in np.flatnonzero((drawn == step).any(axis=0)):
            here = (drawn[:, j] == step)[walk]
            for k, word in enumerate(words[1:]):
                agreed[j, k] |= here & (words[0] == word)
        offs = [off + _moves(w, step, walk + 1) for w, off in zip(words, offs, strict=True)]
    # windows with too many foreign words are left out before they walk
    foreign = [(text[:, k:k + size] >> np.uint64(63)).sum(axis=1) for k in range(2 * SHIFT + 1)]
    agreed &= np.array([f <= edits for f in foreign])[:, row]
    for count in range(len(agreed), 0, -1):
        met = agreed[:count].all(axis=0).any(axis=0).reshape(PAIRS, MOST_REPEATS)
        recall = np.logical_or.accumulate(met, axis=1).mean(axis=0)
        if recall[-1] >= target:
            return count, int(np.argmax(recall >= target)) + 1
    return 1, MOST_REPEATS


@dataclass
class Probe:
    """One embedding of all windows of a size."""
    size: int
    repeat: int
    count: int
    foreign: int
    """how many words that no item holds a window may have"""
    known: list[np.ndarray]
    """per sample the keys' prefixes"""
    found: dict[int, list[tuple[int, int]]]
    """key -> (item, offset) of the windows of items"""


@dataclass
class Index:
    rate: float
    items: dict[int, np.ndarray]
    vocabulary: np.ndarray
    """bits of the words that items hold"""
    windows: list[Probe]
    """item-sized windows, a probe per size and repeat"""
    pieces: list[Probe]
    """pieces one of which no edits reach, a probe per size"""


def _walk(words: np.ndarray, at: np.ndarray, probe: Probe) -> tuple[np.ndarray, np.ndarray]:
    """(windows still alive, keys): the embedding's symbols at the sampled steps, mixed to a key.

    At each step a window's symbol is the word under its pointer; a random bit of (step, word)
    says whether the pointer moves on. Behind the window's ``size`` words there is 0. Windows whose
    key so far no item has are left."""
    size = probe.size
    wanted = samples(size, probe.repeat, probe.count)
    off = np.zeros(len(at), np.int64)
    keys = np.full(len(at), np.uint64(size), np.uint64)
    padded = np.concatenate([words, np.zeros(1, np.uint64)])
    end = len(words)
    alive = at
    for step in range(wanted[-1] + 1):
        word = padded[np.where(off < size, np.minimum(alive + off, end), end)]
        if step in wanted:
            keys = mixed(keys * GAMMA + word)
            have = probe.known[wanted.index(step)]
            near = np.searchsorted(have, keys)
            stays = have[np.minimum(near, len(have) - 1)] == keys
            alive, off, keys, word = alive[stays], off[stays], keys[stays], word[stays]
            if not len(alive):
                break
        off = off + _moves(word, step, probe.repeat)
    return alive, keys


def _probe(items: dict[int, np.ndarray], places: list[tuple[int, int]], size: int, repeat: int, count: int,
           foreign: int) -> Probe:
    """The probe for the windows of items that start at ``places``, (item, offset)."""
    wanted = samples(size, repeat, count)
    prefixes: list[list[np.uint64]] = [[] for _ in wanted]
    found: dict[int, list[tuple[int, int]]] = {}
    for item, offset in places:
        words = items[item][offset:offset + size]
        at, keys = 0, np.full(1, np.uint64(size), np.uint64)
        for step in range(wanted[-1] + 1):
            word = words[at:at + 1] if at < len(words) else np.zeros(1, np.uint64)
            if step in wanted:
                keys = mixed(keys * GAMMA + word)
                prefixes[wanted.index(step)].append(keys[0])
            at += int(_moves(word, step, repeat)[0])
        found.setdefault(int(keys[0]), []).append((item, offset))
    return Probe(size, repeat, count, foreign, [np.unique(np.array(p, np.uint64)) for p in prefixes], found)


def _bit(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(64 - VOCABULARY_BITS)).astype(np.int64)


def build(items: dict[int, np.ndarray], rate: float, target: float = TARGET) -> Index:
    vocabulary = np.zeros(1 << VOCABULARY_BITS, bool)
    whole: dict[int, list[tuple[int, int]]] = {}
    parts: dict[int, list[tuple[int, int]]] = {}
    most: dict[int, int] = {}
    for item, words in items.items():
        vocabulary[_bit(words)] = True
        edits = _most(rate, len(words))
        size = _sizes(len(words))
        whole.setdefault(size, []).append((item, 0))
        most[size] = max(most.get(size, 0), edits)
        for offset, part in cuts(len(words), edits):
            parts.setdefault(part, []).append((item, offset))
    windows = []
    for size, places in whole.items():
        count, repeats = repeats_for(size, most[size], target)
        windows += [_probe(items, places, size, r, count, most[size]) for r in range(1, repeats + 1)]
    pieces = [_probe(items, places, size, 0, SAMPLES, 0) for size, places in parts.items()]
    return Index(rate, items, vocabulary, windows, pieces)


def best_match(item: np.ndarray, words: np.ndarray) -> tuple[int, int]:
    """(edits, end): the fewest word edits that turn the item into some run of ``words``, and where
    the first such run ends. Myers' bit-parallel columns in whole Python numbers."""
    n = len(item)
    masks: dict[int, int] = {}
    for i, w in enumerate(item.tolist()):
        masks[w] = masks.get(w, 0) | 1 << i
    full, top = (1 << n) - 1, 1 << (n - 1)
    plus, minus, score = full, 0, n
    best, end = n, 0
    for j, w in enumerate(words.tolist()):
        eq = masks.get(w, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        ph = minus | (~(xh | plus) & full)
        mh = plus & xh
        score += 1 if ph & top else -1 if mh & top else 0
        ph, mh = (ph << 1) & full, (mh << 1) & full
        plus = mh | (~(xv | ph) & full)
        minus = ph & xv
        if score < best:
            best, end = score, j + 1
    return best, end


def matches(texts: list[np.ndarray], index: Index, fallback: bool = True
            ) -> list[tuple[int, int, int, int]]:
    """(text, item, edits, end) of the items that some run of a text's words holds with at most
    rate * length edits: the fewest edits, and the first end with them. The item-sized windows meet them with
    the index's target recall; ``fallback`` adds those that hold a piece of an item as it is, and
    thereby all. The texts are laid end to end, parted by more empty words than a window may have
    foreign ones, so that one walk serves them all."""
    probes = [*index.windows, *(index.pieces if fallback else ())]
    gap = np.zeros(max((p.foreign for p in probes), default=0) + 1, np.uint64)
    parts = [p for t in texts for p in (t, gap)]
    words = np.concatenate([np.zeros(0, np.uint64), *parts])
    begins = np.cumsum([0, *[len(t) + len(gap) for t in texts]])
    outside = np.concatenate([[0], np.cumsum((words == 0) | ~index.vocabulary[_bit(words)])])
    hits: dict[tuple[int, int], set[int]] = {}
    starts_of: dict[tuple[int, int], np.ndarray] = {}
    for probe in probes:
        size, cell = probe.size, (probe.size, probe.foreign)
        if cell not in starts_of:
            starts_of[cell] = np.flatnonzero(outside[size:] - outside[:-size] <= probe.foreign)
        if not len(starts_of[cell]):
            continue
        alive, keys = _walk(words, starts_of[cell], probe)
        owners = np.searchsorted(begins, alive, side="right") - 1
        for at, key, owner in zip(alive.tolist(), keys.tolist(), owners.tolist(), strict=True):
            for item, offset in probe.found.get(key, ()):
                if probe.repeat or np.array_equal(
                        words[at:at + size], index.items[item][offset:offset + size]):
                    hits.setdefault((owner, item), set()).add(at - int(begins[owner]) - offset)
    out = []
    for (owner, item), places in hits.items():
        own, text = index.items[item], texts[owner]
        most = _most(index.rate, len(own))
        spans: list[list[int]] = []
        for at in sorted(places):
            if spans and at - most <= spans[-1][1]:
                spans[-1][1] = at + len(own) + most
            else:
                spans.append([max(0, at - most), at + len(own) + most])
        edits, end = min((edits, low + end) for low, high in spans
                         for edits, end in [best_match(own, text[low:high])])
        if edits <= most:
            out.append((owner, item, edits, end))
    return sorted(out)


def pieces(texts: list[str | None]) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """(row numbers, words) of the texts that have words, in blocks of about ``PIECE`` words."""
    rows, block, held = [], [], 0
    for i, text in enumerate(texts):
        own = tokens(text)
        if len(own):
            rows.append(i)
            block.append(own)
            held += len(own)
        if held >= PIECE:
            yield rows, block
            rows, block, held = [], [], 0
    if block:
        yield rows, block


def contaminated(df: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text: str = "text", rate: float = 0.1,
                 block_words: int = 2_000_000, target: float = TARGET, fallback: bool = True) -> DataFrame:
    """(id, item, edits, item_words, end): per document and benchmark item the best passage within
    ``rate`` * length word edits, and the word it ends before.

    Items go out in blocks of at most about ``block_words`` words, each a broadcast of bounded
    size, and all documents are scanned for each block. Item-sized windows start at every word of the
    whole text. A random walk embeds a window, so that few edits change few of its symbols; each
    repeat samples some of them as a key, and windows that share a key with an item are
    compared with it by exact edit distance. The repeats follow from the window size, its edits and the recall
    ``target`` (``repeats_for``). With ``fallback`` an item that may have e edits is cut into e + 1 pieces as
    well, one of which every passage within e edits holds as it is; that finds what the windows
    missed. Items without words (NULL, empty, blanks) match nothing, nor do such texts; equal items and
    repeated rows of both tables each get their rows, and different texts of one item theirs; a NULL id of
    a document or an item stays NULL; ids have any type that Arrow carries; empty tables give no rows."""
    docs = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    bench = items.select(F.col(f"`{item_col}`").alias("item"),
                         F.col(f"`{item_text}`").alias("text"))
    total = bench.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / 2 / block_words))
    kind = df.select(F.col(f"`{id_col}`")).schema[0].dataType.simpleString()
    kind_of_item = bench.schema["item"].dataType
    schema = f"id {kind}, item {kind_of_item.simpleString()}, edits long, item_words long, end long"
    arrow = to_arrow_type(kind_of_item)
    spark = df.sparkSession
    out = None
    for block in range(blocks):
        mine = bench.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block)
        rows_of: dict[bytes, list[int | None]] = {}
        for r in mine.toLocalIterator():
            own = tokens(r["text"])
            if len(own):
                rows_of.setdefault(own.tobytes(), []).append(r["item"])
        if not rows_of:
            continue
        index = build({k: np.frombuffer(own, np.uint64) for k, own in enumerate(rows_of)},
                      rate, target)
        shared = spark.sparkContext.broadcast((index, list(rows_of.values())))

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index, names = shared.value
            for batch in batches:
                rows = [(at[m[0]], name, *m[2:], len(index.items[m[1]]))
                        for at, block in pieces(batch.column("text").to_pylist())
                        for m in matches(block, index, fallback) for name in names[m[1]]]
                if rows:
                    at, item, edits, end, size = (list(x) for x in zip(*rows, strict=True))
                    yield pa.RecordBatch.from_arrays([
                        batch.column("id").take(pa.array(at)), pa.array(item, arrow),
                        pa.array(edits, pa.int64()), pa.array(size, pa.int64()),
                        pa.array(end, pa.int64())], schema=pa.schema([
                            ("id", batch.schema.field("id").type), ("item", arrow),
                            *[(c, pa.int64()) for c in ("edits", "item_words", "end")]]))

        part = docs.mapInArrow(scan, schema)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], schema) if out is None else out


def decontaminate(df: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  **options) -> DataFrame:
    """The rows whose own text holds no item, unchanged, whatever their id (NULL and shared ids too)."""
    row = free_name(df, "_row")
    tagged = df.withColumn(row, F.md5(F.col(f"`{text_col}`").cast("binary")))
    bad = contaminated(tagged.select(F.col(row).alias("id"), F.col(f"`{text_col}`").alias("text")), items,
                       "id", "text", **options).select(F.col("id").alias(row)).distinct()
    return without(tagged.join(bad, row, "left_anti"), row)

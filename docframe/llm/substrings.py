"""Exact substring dedup with a logarithmic family of sorted suffix runs.

A run holds sampled suffixes of a batch of documents in sorted order. A suffix is sampled if its
first ``GRAM`` bytes have the least hash in some window of ``SPAN`` bytes, so every string of
``SPAN`` bytes holds a sampled suffix at a place that the string alone decides, and equal
strings meet at it. Suffixes are ordered by the hash of those bytes and of their surroundings (all
bytes that a string of ``SPAN`` bytes through the sampled place may touch).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pairs, stored
from .neardup import GAMMA, mixed

SPAN = 50
GRAM = 20
REACH = SPAN - GRAM
WIDTH = REACH + SPAN
BASE = np.uint64(0x100000001B3)
BLOCK = 1 << 19
BATCH_BYTES = 1 << 22
CROWDED = 64
FAN = 4
NO_ID = (1 << 63) - 1
COVERED, CONTESTED, HOT = 1, 2, 3


def rolling(x: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all windows of ``width`` along the last axis, by doubling."""
    powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(width, BASE)]))
    count = x.shape[-1] - width + 1
    out, at = np.zeros((*x.shape[:-1], count), np.uint64), 0
    size, part, left = 1, x, width
    while left:
        if left & 1:
            out = out * powers[size] + part[..., at:at + count]
            at += size
        left >>= 1
        if left:
            part = part[..., :-size] * powers[size] + part[..., size:]
            size *= 2
    return mixed(out)


def _sliding(pick: np.ufunc, x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        x = pick(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return pick(x[:len(x) - rest], x[rest:]) if rest else x


def _strewn(data: np.ndarray) -> np.ndarray:
    return mixed((data.astype(np.uint64) + np.uint64(1)) * GAMMA)


@dataclass
class Run:
    """Sampled suffixes sorted by (gram, around): owner, place, the smallest id with the same
    surroundings, whether the gram has other surroundings, and whether it is too frequent."""

    gram: np.ndarray
    around: np.ndarray
    doc: np.ndarray
    at: np.ndarray
    least: np.ndarray
    several: np.ndarray
    hot: np.ndarray


def merge(runs: list[Run]) -> Run:
    """One sorted run of several; what they tell of each other is carried over."""
    gram, around = (np.concatenate([getattr(r, c) for r in runs]) for c in ("gram", "around"))
    order = np.lexsort((around, gram))
    gram, around = gram[order], around[order]

    def sorted_column(name: str) -> np.ndarray:
        return np.concatenate([getattr(r, name) for r in runs])[order]

    run = Run(gram, around, *[sorted_column(c) for c in ("doc", "at", "least", "several", "hot")])
    if not len(order):
        return run
    new_gram = np.concatenate([[True], gram[1:] != gram[:-1]])
    new = new_gram | np.concatenate([[True], around[1:] != around[:-1]])
    run.least = np.minimum.reduceat(run.least, np.flatnonzero(new))[np.cumsum(new, dtype=np.int32) - 1]
    grams = np.flatnonzero(new_gram)
    of_gram = np.cumsum(new_gram, dtype=np.int32) - 1
    run.several = (np.add.reduceat(new.astype(np.int32), grams) > 1)[of_gram]
    run.hot = np.logical_or.reduceat(run.hot, grams)[of_gram]
    return run


class Family:
    """Runs in levels: a new batch is a run of level 0, and ``FAN`` runs of a level merge into
    one of the next, so an entry is merged as often as there are levels."""

    def __init__(self) -> None:
        self.levels: list[list[Run]] = []

    def add(self, run: Run) -> None:
        level = 0
        while True:
            if len(self.levels) == level:
                self.levels.append([])
            self.levels[level].append(run)
            if len(self.levels[level]) < FAN:
                return
            run, self.levels[level] = merge(self.levels[level]), []
            level += 1

    def whole(self) -> Run | None:
        runs = [r for level in self.levels for r in level]
        return merge(runs) if runs else None


def sampled(datas: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(owner, place, gram hash, hash of the surroundings) of the sampled suffixes of some texts."""
    lengths = np.array([len(d) for d in datas], np.int64)
    data = np.frombuffer(b"".join(datas), np.uint8)
    ends = np.cumsum(lengths)
    begins = ends - lengths
    if len(data) < SPAN:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64), none.astype(np.uint64)
    grams = rolling(_strewn(data), GRAM) | np.uint64(1)
    least = _sliding(np.minimum, grams, REACH + 1)
    inside = np.zeros(len(least) + 1, np.int64)
    fit = lengths >= SPAN
    np.add.at(inside, begins[fit], 1)
    np.add.at(inside, ends[fit] - SPAN + 1, -1)
    least = np.where(np.cumsum(inside)[:-1] > 0, least, np.uint64(0))
    edge = np.zeros(REACH, np.uint64)
    most = _sliding(np.maximum, np.concatenate([edge, least, edge]), REACH + 1)
    at = np.flatnonzero(most == grams)
    owner = np.searchsorted(ends, at, side="right")
    around = surroundings(data, at, begins[owner], ends[owner])
    words = np.ascontiguousarray(around).view(np.uint64)
    mix = np.zeros(len(at), np.uint64)
    for k in range(words.shape[1]):
        mix = mixed(mix * GAMMA + words[:, k])
    return owner, at - begins[owner], grams[at], mix


def surroundings(data: np.ndarray, at: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The ``WIDTH`` bytes round each place; 0xFF, which no UTF-8 text holds, beyond its text."""
    places = at[:, None] + np.arange(-REACH, SPAN)
    out = data[np.clip(places, 0, len(data) - 1)]
    out[(places < begins[:, None]) | (places >= ends[:, None])] = 0xFF
    return out


def _planes(x: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of the numbers, byte by byte, which shuffles compress well."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _numbers(raw: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").ravel()


def _by_part(part: np.ndarray, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(part, kind="stable")
    cuts = np.searchsorted(part[order], np.arange(parts + 1))
    for p in range(parts):
        if cuts[p] < cuts[p + 1]:
            yield p, order[cuts[p]:cuts[p + 1]]


def _cell(x: np.ndarray, parts: int) -> np.ndarray:
    """The range of a hash: its top bits, scaled. Sampled hashes are least ones, so all of them are
    small; they are mixed again first."""
    return ((mixed(x) >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def _spread(doc: np.ndarray, parts: int) -> np.ndarray:
    return _cell(mixed(doc.astype(np.uint64) + np.uint64(77)), parts)


ENTRIES = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("gram", pa.binary()),
                     ("around", pa.binary()), ("doc", pa.binary()), ("at", pa.binary()),
                     ("hot", pa.binary())])
ENTRIES_SQL = "part int, kind int, gram binary, around binary, doc binary, at binary, hot binary"
ANSWERS = pa.schema([("part", pa.int32()), ("doc", pa.binary()), ("at", pa.binary()),
                     ("kind", pa.binary())])
ANSWERS_SQL = "part int, doc binary, at binary, kind binary"


def _answers(doc: np.ndarray, at: np.ndarray, kind: np.ndarray, parts: int) -> Iterator[dict]:
    for p, own in _by_part(_spread(doc, parts), parts):
        yield {"part": p, "doc": _planes(doc[own], 8), "at": _planes(at[own], 5),
               "kind": kind[own].astype(np.uint8).tobytes()}


def _index_batch(docs: list[int], datas: list[bytes], parts: int) -> Iterator[dict]:
    """Rows of one batch: its sorted run, cut by ranges of the gram, and what it knows already."""
    pieces, held, block = [], 0, []
    for k, data in enumerate(datas):
        # a long text goes in blocks; windows of SPAN bytes lie in exactly one
        for at in range(0, max(1, len(data) - SPAN + 1), BLOCK):
            block.append((k, at, data[at:at + BLOCK + SPAN - 1]))
            held += len(block[-1][2])
            if held >= BLOCK:
                pieces.append(block)
                block, held = [], 0
    pieces.append(block)
    found = []
    ids = np.array(docs, np.int64)
    for block in pieces:
        if not block:
            continue
        owner, at, gram, around = sampled([b[2] for b in block])
        texts, shift = np.array([b[0] for b in block]), np.array([b[1] for b in block], np.int64)
        cutting = np.array([b[1] > 0 or len(b[2]) < len(datas[b[0]]) for b in block])
        place = at + shift[owner]
        for j in np.flatnonzero(cutting[owner]):
            # surroundings that reach into the neighbouring block
            whole = np.frombuffer(datas[texts[owner[j]]], np.uint8)
            row = surroundings(whole, place[j:j + 1], np.zeros(1, np.int64),
                               np.full(1, len(whole), np.int64))
            mix = np.zeros(1, np.uint64)
            for w in np.ascontiguousarray(row).view(np.uint64).T:
                mix = mixed(mix * GAMMA + w)
            around[j] = mix[0]
        found.append((ids[texts[owner]], place, gram & ~np.uint64(0xFFFF), around & np.uint64((1 << 48) - 1)))
    if not found:
        return
    doc, at, gram, around = (np.concatenate(c) for c in zip(*found, strict=True))
    found.clear()
    none = np.zeros(len(doc), bool)
    run = merge([Run(gram, around, doc, at, doc, none, none)])
    if not len(run.doc):
        return
    new_gram = np.concatenate([[True], run.gram[1:] != run.gram[:-1]])
    new = new_gram | np.concatenate([[True], run.around[1:] != run.around[:-1]])
    of_gram = np.cumsum(new_gram) - 1
    crowded = np.add.reduceat(new.astype(np.int64), np.flatnonzero(new_gram))[of_gram] > CROWDED
    known = run.doc > run.least
    place = np.arange(len(run.doc)) - np.flatnonzero(new_gram)[of_gram]
    # of a crowded gram only its first two entries go to its range, to mark it there
    aside = known | (crowded & (place > 1))
    kind = np.where(known, COVERED, HOT)[aside]
    for row in _answers(run.doc[aside], run.at[aside], kind, parts):
        yield {"part": row["part"], "kind": 1, "gram": b"", "around": b"", "doc": row["doc"],
               "at": row["at"], "hot": row["kind"]}
    stay = np.flatnonzero(~aside | (crowded & (place <= 1)))
    for p, own in _by_part(_cell(run.gram[stay], parts), parts):
        own = stay[own]
        yield {"part": p, "kind": 0, "gram": _planes(run.gram[own] >> np.uint64(16), 6),
               "around": _planes(run.around[own], 6), "doc": _planes(run.doc[own], 8),
               "at": _planes(run.at[own], 5), "hot": crowded[own].astype(np.uint8).tobytes()}


def _scan_range(table: pa.Table, parts: int) -> Iterator[dict]:
    """The family of one range of grams: batches are added one by one; in the end every entry
    knows the smallest id with its surroundings."""
    family = Family()
    rows = table.to_pylist()
    for r in sorted((r for r in rows if r["kind"] == 0), key=lambda r: (r["doc"][:1], len(r["doc"]))):
        doc = _numbers(r["doc"], 8).view(np.int64)
        hot = np.frombuffer(r["hot"], np.uint8).astype(bool)
        family.add(Run(_numbers(r["gram"], 6), _numbers(r["around"], 6), doc,
                       _numbers(r["at"], 5).view(np.int64), doc, hot, hot))
    run = family.whole()
    for r in rows:
        if r["kind"] == 1:
            doc = _numbers(r["doc"], 8).view(np.int64)
            yield from _answers(doc, _numbers(r["at"], 5).view(np.int64),
                                np.frombuffer(r["hot"], np.uint8), parts)
    if run is None or not len(run.doc):
        return
    new_gram = np.concatenate([[True], run.gram[1:] != run.gram[:-1]])
    starts, of_gram = np.flatnonzero(new_gram), np.cumsum(new_gram) - 1
    docs = (np.minimum.reduceat(run.doc, starts) < np.maximum.reduceat(run.doc, starts))[of_gram]
    kind = np.where(run.doc > run.least, COVERED, np.where(
        run.hot, HOT, np.where(run.several & docs, CONTESTED, 0)))
    told = kind > 0
    yield from _answers(run.doc[told], run.at[told], kind[told], parts)


PROBES = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("key", pa.binary()),
                    ("doc", pa.binary()), ("at", pa.binary())])
PROBES_SQL = "part int, kind int, key binary, doc binary, at binary"


def _places(table: pa.Table) -> dict[int, list[tuple[np.ndarray, np.ndarray]]]:
    """doc -> its answers' (place, kind)."""
    if not table.num_rows:
        return {}
    doc = np.concatenate([_numbers(x, 8).view(np.int64) for x in table.column("doc").to_pylist()])
    at = np.concatenate([_numbers(x, 5).view(np.int64) for x in table.column("at").to_pylist()])
    kind = np.concatenate([np.frombuffer(x, np.uint8) for x in table.column("kind").to_pylist()])
    order = np.argsort(doc, kind="stable")
    doc, at, kind = doc[order], at[order], kind[order]
    cuts = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1], [True]]))
    return {int(doc[a]): (at[a:b], kind[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)}


def _first_holders(key: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Whether a smaller id holds the same key."""
    order = np.argsort(key, kind="stable")
    new = np.concatenate([[True], key[order][1:] != key[order][:-1]])
    least = np.minimum.reduceat(doc[order], np.flatnonzero(new))[np.cumsum(new) - 1]
    out = np.empty(len(key), bool)
    out[order] = doc[order] > least
    return out


def _probe(texts: pa.Table, answers: pa.Table, parts: int) -> Iterator[dict]:
    """What has to be compared byte by byte: surroundings of contested places, by their gram, and
    single strings of ``SPAN`` bytes of hot ones, by their own hash."""
    places = _places(answers)
    unpack = zstandard.ZstdDecompressor()
    around, docs, ats, grams, keys, key_docs, key_ats = [], [], [], [], [], [], []
    for doc, packed in zip(texts.column("id").to_pylist(), texts.column("data").to_pylist(), strict=True):
        if doc not in places:
            continue
        at, kind = places[doc]
        if not (kind > COVERED).any():
            continue
        data = np.frombuffer(unpack.decompress(packed), np.uint8)
        at, kind = at[at <= len(data) - GRAM], kind[at <= len(data) - GRAM]
        own = np.unique(at[kind == CONTESTED])
        if len(own):
            rows = surroundings(data, own, np.zeros(len(own), np.int64), np.full(len(own), len(data)))
            around.append(rows)
            docs.append(np.full(len(own), doc))
            ats.append(own)
            grams.append(rolling(_strewn(rows[:, REACH:REACH + GRAM]), GRAM)[:, 0])
        own = np.unique(at[kind == HOT])
        if len(own) and len(data) >= SPAN:
            starts = np.unique(own[:, None] + np.arange(-REACH, 1))
            starts = starts[(starts >= 0) & (starts <= len(data) - SPAN)]
            key = _strings(data[starts[:, None] + np.arange(SPAN)])[:, 0]
            keys.append(key)
            key_docs.append(np.full(len(key), doc))
            key_ats.append(starts)
    if docs:
        rows, doc, at, gram = (np.concatenate(x) for x in (around, docs, ats, grams))
        for p, own in _by_part(_cell(gram, parts), parts):
            yield {"part": p, "kind": 0, "key": rows[own].tobytes(), "doc": _planes(doc[own], 8),
                   "at": _planes(at[own], 5)}
    if keys:
        key, doc, at = (np.concatenate(x) for x in (keys, key_docs, key_ats))
        order = np.lexsort((doc, key))
        key, doc, at = key[order], doc[order], at[order]
        for p, own in _by_part(_cell(key, parts), parts):
            yield {"part": p, "kind": 1, "key": _planes(key[own], 8), "doc": _planes(doc[own], 8),
                   "at": _planes(at[own], 5)}


def _strings(rows: np.ndarray) -> np.ndarray:
    return rolling(_strewn(rows), SPAN)


def _resolve(table: pa.Table, parts: int) -> Iterator[dict]:
    keys, docs, ats = [], [], []
    for r in table.to_pylist():
        doc, at = _numbers(r["doc"], 8).view(np.int64), _numbers(r["at"], 5).view(np.int64)
        if r["kind"] == 1:
            keys.append(_numbers(r["key"], 8))
            docs.append(doc)
            ats.append(at)
            continue
        rows = np.frombuffer(r["key"], np.uint8).reshape(-1, WIDTH)
        for a in range(0, len(rows), 1 << 14):
            part = rows[a:a + (1 << 14)]
            outside = np.cumsum(np.pad(part == 0xFF, ((0, 0), (1, 0))), axis=1)
            whole = outside[:, SPAN:] == outside[:, :-SPAN]
            own, off = np.nonzero(whole)
            keys.append(_strings(part)[own, off])
            docs.append(doc[a:a + (1 << 14)][own])
            ats.append(at[a:a + (1 << 14)][own] - REACH + off)
    if not keys:
        return
    key, doc, at = (np.concatenate(x) for x in (keys, docs, ats))
    if not len(key):
        return
    held = _first_holders(key, doc)
    yield from _answers(doc[held], at[held], np.full(int(held.sum()), HOT), parts)


def _cover(texts: pa.Table, answers: pa.Table) -> Iterator[dict]:
    """Spans and kept bytes per text. COVERED answers are sampled places whose surroundings go
    whole, HOT ones are strings of ``SPAN`` bytes."""
    places = _places(answers)
    unpack = zstandard.ZstdDecompressor()
    for doc, packed in zip(texts.column("id").to_pylist(), texts.column("data").to_pylist(), strict=True):
        data = unpack.decompress(packed)
        spans: list[dict] = []
        kept = data
        if doc in places:
            at, kind = places[doc]
            low = np.clip(np.where(kind == COVERED, at - REACH, at), 0, len(data))
            high = np.clip(at + SPAN, 0, len(data))
            depth = np.zeros(len(data) + 1, np.int64)
            np.add.at(depth, low, 1)
            np.add.at(depth, high, -1)
            gone = np.cumsum(depth)[:-1] > 0
            turns = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
            spans = [{"start": a, "end": b} for a, b in turns.reshape(-1, 2).tolist()]
            kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        yield {"id": None if doc == NO_ID else doc, "n_bytes": len(data), "spans": spans, "kept": kept}


OUT = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("spans", pa.list_(pa.struct(
    [("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary())])


def _tables(rows: Iterator[dict], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_pylist(list(rows), schema=schema)


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   part_bytes: int = 3 << 21) -> DataFrame:
    """(id, n_bytes, spans, kept) of every row: the text's bytes without those covered by a string of
    50 bytes that also starts in a text with a smaller id. Strings are judged on the input.

    Texts are cut into batches of about 4 MB; a batch's sampled suffixes make a sorted run,
    and ranges of runs go to the family that holds the range. A place whose surroundings a smaller
    id has is covered whole. Where only part of them is alike, the surroundings are compared
    byte by byte, string by string. The number of ranges grows with the input, so that a
    range stays near ``part_bytes`` of text. Copies inside a batch send one entry; a gram with
    more than 64 different surroundings in a batch is not gathered but compared by its strings'
    own hashes, which lie in all ranges.

    A NULL text is empty. A NULL id counts as larger than any other. Rows that share an id do not
    match each other; they are taken to hold the same text (of different ones, what is found in
    one counts for all). Empty tables give no rows; other columns are not read."""
    rows = df.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID)).alias("id"),
                     F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(4, math.ceil(size / part_bytes))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, datas, held = [], [], 0
        for batch in batches:
            for doc, text in pairs(batch, "id", "text"):
                data = text.encode("utf-8", "replace")
                if len(data) >= SPAN:
                    docs.append(doc)
                    datas.append(data)
                    held += len(data)
                if held >= BATCH_BYTES:
                    yield from _tables(_index_batch(docs, datas, parts), ENTRIES).to_batches()
                    docs, datas, held = [], [], 0
        yield from _tables(_index_batch(docs, datas, parts), ENTRIES).to_batches()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            ids = batch.column("id").to_numpy()
            yield pa.RecordBatch.from_arrays([
                pa.array(_spread(ids, parts), pa.int32()), batch.column("id"),
                pa.array([squeeze.compress(t.encode("utf-8", "replace"))
                          for _, t in pairs(batch, "id", "text")], pa.binary())],
                names=["part", "id", "data"])

    entries = rows.mapInArrow(index, ENTRIES_SQL).repartition(parts, "part")
    told = stored(entries.groupBy("part").applyInArrow(
        lambda t: _tables(_scan_range(t, parts), ANSWERS), ANSWERS_SQL))
    texts = rows.mapInArrow(pack, "part int, id long, data binary")
    probes = texts.groupBy("part").cogroup(told.groupBy("part")).applyInArrow(
        lambda t, a: _tables(_probe(t, a, parts), PROBES), PROBES_SQL)
    strings = probes.groupBy("part").applyInArrow(
        lambda t: _tables(_resolve(t, parts), ANSWERS), ANSWERS_SQL)

    def cover(t: pa.Table, a: pa.Table) -> pa.Table:
        return _tables(_cover(t, a), OUT)

    told_only = told.mapInArrow(_only_covered, ANSWERS_SQL)
    settled = told_only.unionByName(strings)
    return texts.groupBy("part").cogroup(settled.groupBy("part")).applyInArrow(
        cover, "id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")


def _only_covered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Without the answers that only ask for a comparison."""
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            kind = np.frombuffer(r["kind"], np.uint8)
            own = kind == COVERED
            if own.any():
                out.append({"part": r["part"], "doc": _planes(_numbers(r["doc"], 8)[own], 8),
                            "at": _planes(_numbers(r["at"], 5)[own], 5), "kind": kind[own].tobytes()})
        yield from pa.Table.from_pylist(out, schema=ANSWERS).to_batches()

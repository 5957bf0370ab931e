"""MinHash near-dedup with tensored banding."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, free_name, pairs, stored, without, workspace
from .graph import components

SHINGLE = 5
SIDE = 16
ROWS = 3
STEP = 1 << 13
DEVIATIONS = 4.2
BLOCK_BYTES = 1 << 22
GAMMA = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64 on unsigned 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's windows of five words, A to Z in lower
    case; of the whole sequence if it is shorter; nothing for no words."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    width = min(SHINGLE, len(h))
    out = np.full(len(h) - width + 1, np.uint64(width), np.uint64)
    for k in range(width):
        out = mixed(out * GAMMA + h[k:len(h) - width + 1 + k])
    return np.unique(out)


def _functions(count: int) -> tuple[np.ndarray, np.ndarray]:
    at = mixed(np.arange(1, 2 * count + 1, dtype=np.uint64) * GAMMA)
    return at[:count] | np.uint64(1), at[count:]


def minhashes(values: np.ndarray, count: int) -> np.ndarray:
    """The least value of each of ``count`` hash functions over a set, block by block."""
    times, plus = _functions(count)
    out = np.full(count, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(values), STEP):
        part = mixed(values[at:at + STEP])
        for k in range(count):
            out[k] = min(out[k], (part * times[k] + plus[k]).min())
    return out


def _sketch(least: np.ndarray) -> np.ndarray:
    """Four bits of each minhash, packed into 64-bit numbers."""
    nibbles = (mixed(least) & np.uint64(15)).astype(np.uint8)
    return (nibbles[0::2] << 4 | nibbles[1::2]).view(np.int64)


def signatures(rows: DataFrame) -> DataFrame:
    """(id, row, n, whole, left, right, sketch) per (id, row, text): the size and the 128-bit hash of the shingle set,
    the two collections of ``SIDE`` keys of ``ROWS`` minhashes, and a sketch for estimates."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("n", "whole", "left", "right", "sketch")}
            for text in batch.column("text").to_pylist():
                values = shingles(text)
                out["n"].append(len(values))
                if not len(values):
                    for k in ("whole", "left", "right", "sketch"):
                        out[k].append(None)
                    continue
                flat = minhashes(values, 2 * SIDE * ROWS)
                least = flat.reshape(2 * SIDE, ROWS)
                keys = least[:, 0]
                for k in range(1, ROWS):
                    keys = mixed(keys * GAMMA + least[:, k])
                keys = keys.view(np.int64)
                out["whole"].append(xxhash.xxh3_128_digest(values.tobytes()))
                out["left"].append(keys[:SIDE])
                out["right"].append(keys[SIDE:])
                out["sketch"].append(_sketch(flat))
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("row"), pa.array(out["n"], pa.int64()),
                 pa.array(out["whole"], pa.binary()),
                 *[pa.array(out[k], longs) for k in ("left", "right", "sketch")]],
                names=["id", "row", "n", "whole", "left", "right", "sketch"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "row", "text").mapInArrow(
        sign, f"id {kind}, row long, n long, whole binary, left array<long>, right array<long>, "
              "sketch array<long>")


def _packed(rows: DataFrame) -> DataFrame:
    """(id, row, data): the texts, compressed for the shuffle."""

    def press(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("row"), pa.array(
                [squeeze.compress((t or "").encode("utf-8", "replace"))
                 for _, t in pairs(batch, "id", "text")], pa.binary())], names=["id", "row", "data"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "row", "text").mapInArrow(press, f"id {kind}, row long, data binary")


def _sets(rows: DataFrame) -> DataFrame:
    """(id, set): the sorted 64-bit shingle hashes, of compressed texts."""

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loosen = zstandard.ZstdDecompressor()
        for batch in batches:
            held = [shingles(loosen.decompress(t).decode()).tobytes() for _, t in pairs(batch, "id", "data")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(held, pa.binary())], names=["id", "set"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "data").mapInArrow(take, f"id {kind}, set binary")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= percent * union."""
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("sa")), "a").join(
        sets.select(F.col("id").alias("b"), F.col("set").alias("sb")), "b")

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("sa"), batch.column("sb"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                joint = len(x) + len(y) - len(np.union1d(x, y))
                keep.append(100 * joint >= percent * (len(x) + len(y) - joint))
            found = batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
            if found.num_rows:
                yield found

    kind = pairs.schema["a"].dataType.simpleString()
    return both.select("a", "b", "sa", "sb").mapInArrow(test, f"a {kind}, b {kind}")


def _most(percent: int) -> int:
    """How many places of their sketches may differ: ``DEVIATIONS`` standard deviations above what is
    expected of sets with the asked similarity."""
    count = 2 * SIDE * ROWS
    share = (1 - percent / 100) * 15 / 16
    return int(count * share + DEVIATIONS * (count * share * (1 - share)) ** 0.5)


def _near(a: str, b: str, percent: int) -> Column:
    """Whether the sketches are alike enough to go on."""
    count = 2 * SIDE * ROWS
    differ = F.lit(0)
    for k in range(count // 16):
        x = F.col(a)[k].bitwiseXOR(F.col(b)[k])
        x = x.bitwiseOR(F.shiftright(x, 1))
        x = x.bitwiseOR(F.shiftright(x, 2))
        differ = differ + F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111)))
    return differ <= _most(percent)


def _close(pairs: DataFrame, signs: DataFrame, percent: int) -> DataFrame:
    return pairs.join(signs.select(F.col("id").alias("a"), F.col("sketch").alias("ka")), "a").join(
        signs.select(F.col("id").alias("b"), F.col("sketch").alias("kb")), "b").where(
        _near("ka", "kb", percent)).select("a", "b")


def _placed(members: DataFrame, found: DataFrame | None) -> DataFrame:
    """With the component that the links so far put each id in."""
    if found is None:
        return members.withColumn("component", F.col("id"))
    return members.join(found.select(F.col("node").alias("id"), "component"), "id", "left").withColumn(
        "component", F.coalesce("component", "id"))


def _links(found: DataFrame) -> DataFrame:
    """(a, b): a link from each node to its component's smallest node, which stand for all links so far."""
    return found.select(F.col("component").alias("a"), F.col("node").alias("b"))


def _met(at: int, mine: pa.Table, strays: pa.Table, percent: int) -> tuple[list[int], list[int]]:
    """(stray, member) rows whose sets are alike enough, one per stray and component of members. Pairs are
    looked at where they have their first common key, and only if their components differ."""
    left, own_left = (x["left"].combine_chunks().flatten().to_numpy().reshape(-1, SIDE) for x in (mine, strays))
    wide = 2 * SIDE * ROWS // 16
    sketch, own_sketch = (x["sketch"].combine_chunks().flatten().to_numpy().view(np.uint64).reshape(-1, wide)
                          for x in (mine, strays))
    codes = pa.chunked_array([*mine["component"].chunks, *strays["component"].chunks]).combine_chunks(
        ).dictionary_encode().indices.to_numpy()
    component, own = codes[:mine.num_rows], codes[mine.num_rows:]
    sets = [np.frombuffer(x.as_buffer(), np.uint32) for x in mine["set"]]
    sizes = np.array([len(x) for x in sets])
    ones, most, a, b = np.uint64(0x1111111111111111), _most(percent), [], []
    for i, x in enumerate(strays["set"]):
        x = np.frombuffer(x.as_buffer(), np.uint32)
        fit = (component != own[i]) & (100 * np.minimum(sizes, len(x)) >= percent * np.maximum(sizes, len(x)))
        fit &= ~(left[:, :at] == own_left[i, :at]).any(axis=1)
        rows = np.flatnonzero(fit)
        differ = sketch[rows] ^ own_sketch[i]
        differ |= differ >> np.uint64(1)
        differ |= differ >> np.uint64(2)
        rows = rows[np.bitwise_count(differ & ones).sum(axis=1) <= most]
        if not len(rows):
            continue
        flat = np.concatenate([sets[r] for r in rows])
        place = np.minimum(np.searchsorted(x, flat), len(x) - 1)
        joint = np.add.reduceat((x[place] == flat).astype(np.int64), np.cumsum(sizes[rows]) - sizes[rows])
        rows = rows[100 * joint >= percent * (sizes[rows] + len(x) - joint)]
        rows = rows[np.unique(component[rows], return_index=True)[1]]
        a += [i] * len(rows)
        b += rows.tolist()
    return a, b


def _short(sets: DataFrame) -> DataFrame:
    """(id, set): the sorted low 32 bits of the hashes."""

    def cut_down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [np.unique(np.frombuffer(x.as_buffer(), np.uint64).astype(np.uint32)).tobytes()
                    for x in batch.column("set")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(held, pa.binary())], names=["id", "set"])

    return sets.mapInArrow(cut_down, "id long, set binary")


def _stray_links(placed: DataFrame, strays: DataFrame, sets: DataFrame, percent: int, folder: str) -> DataFrame:
    """(a, b): strays and members of other components with the same key of the left collection whose sets are
    alike enough. A key's members and strays are dealt to a grid of blocks of about ``BLOCK_BYTES`` of
    sets and compared inside a block; what leaves it is a link per stray and component, so no pairs are written, however
    crowded a key is. Sets are compared here by the low halves of their hashes; links are confirmed afterwards."""
    full = placed.join(_short(sets), "id")
    told = full.select("id", "component", F.length("set").alias("bytes"), F.posexplode("left").alias("at", "own")).join(
        strays.withColumn("stray", F.lit(True)), "id", "left")
    # only keys with a stray and with two components; which sets go where is settled before they move
    mine, asking = F.sum("bytes"), F.sum(F.when(F.col("stray"), F.col("bytes")))
    grid = told.groupBy("at", "own").agg(
        F.ceil(mine / BLOCK_BYTES).alias("across"), F.ceil(asking / BLOCK_BYTES).alias("down"),
        F.min("component").alias("low"), F.max("component").alias("high")).where(
        "low <> high and down is not null").drop("low", "high")
    dealt = stored(told.join(grid, ["at", "own"]).drop("bytes", "component"), folder)
    zero = F.lit(0).cast("long")

    def sent(rows: DataFrame, **places: Column) -> DataFrame:
        rows = rows.select("id", "at", "own", *[c.alias(k) for k, c in places.items()], "across", "down")
        for name, count in (("x", "across"), ("y", "down")):
            if name not in places:
                rows = rows.withColumn(name, F.explode(F.sequence(zero, F.col(count) - 1)))
        rows = rows.join(full, "id")
        return rows.select(*[F.col(c).alias(c) for c in cols])

    cell = ["at", "own", "x", "y"]
    cols = [*cell, "id", "component", "sketch", "left", "set"]
    mine = sent(dealt, x=F.pmod(F.xxhash64("id"), "across"))
    asking = sent(dealt.where("stray"), y=F.pmod(F.xxhash64("id"), "down"))

    def compare(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        a, b = _met(key[0].as_py(), left, right, percent)
        return pa.table({"a": right["id"].take(pa.array(a, pa.int64())), "b": left["id"].take(pa.array(b, pa.int64()))})

    return mine.groupBy(*cell).cogroup(asking.groupBy(*cell)).applyInArrow(compare, "a long, b long")


def _cells(heads: DataFrame, folder: str) -> DataFrame:
    """(id, cell, n, leader): the tables' cells that hold two classes or more, with their sizes and
    smallest ids. A cell is a pair of keys; only keys that two classes hold are paired."""
    single = heads.select("id", F.posexplode(F.concat("left", "right")).alias("at", "own")).select(
        "id", (F.col("at") < SIDE).alias("is_left"), F.xxhash64("at", "own").alias("key"))
    twice = single.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    shared = single.join(twice, "key").groupBy("id").agg(
        F.collect_list(F.when(F.col("is_left"), F.col("key"))).alias("left"),
        F.collect_list(F.when(~F.col("is_left"), F.col("key"))).alias("right"))
    tables = shared.select("id", "right", F.explode("left").alias("l")).select(
        "id", "l", F.explode("right").alias("r")).select("id", F.xxhash64("l", "r").alias("cell"))
    tables = stored(tables, folder)
    known = tables.groupBy("cell").agg(F.count("*").alias("n"), F.min("id").alias("leader")).where("n > 1")
    return tables.join(known, "cell")


def classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75
            ) -> DataFrame:
    """(id, row, n, component) of every row, ``row`` being a hash of its text; rows without words are
    their own component.

    Equal sets (by a hash of 128 bits) are one class. Its keys are pairs
    of one key of each of two collections: 16 x 16 tables of six minhashes for the price of 96
    minhashes instead of 1,536. Two sets with a similarity of 0.75 meet in a table with a
    probability of 0.9997 (1 - (1 - s^3)^16 squared). A key that no other class has cannot
    meet, so only keys held twice are paired.

    Members of a cell are compared with its smallest member, and in cells that are then in several
    components with the member that shares most cells with others, which lies amid its copies; so a large group of near
    copies joins up in linear work. Who is then still outside its cell's largest component (a stray) is
    compared with the members of other components block by block (``_stray_links``). Of all pairs, a sketch of the 96
    minhashes rules out those 4.2 standard deviations below 0.75 (one in 70,000 at exactly 0.75); the rest is
    confirmed on the full sets of 64-bit hashes. Copies of one set do not meet each other at all."""
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(f"`{text_col}`").alias("row"),
                     F.col(f"`{text_col}`").alias("text"))
    signed = cut(signatures(rows))
    with workspace(df.sparkSession) as folder:
        # a class gets a number of its own, so rows that share an id do not get mixed up
        heads = stored(signed.where("whole is not null").groupBy("whole").agg(
            F.min("id").alias("low"), F.min(F.struct("id", "row")).alias("one"),
            *[F.first(c).alias(c) for c in ("left", "right", "sketch")]).withColumn(
            "id", F.monotonically_increasing_id()), folder)
        cells = stored(_cells(heads, folder), folder)
        ids = cells.select("id").distinct()
        signs = stored(heads.drop("whole", "low").join(ids, "id", "left_semi"), folder)
        ones = signs.select(F.col("id").alias("class"), F.col("one.id").alias("one"), F.col("one.row").alias("of"))
        packed = _packed(rows)
        texts = packed.join(ones, packed["id"].eqNullSafe(ones["one"]) & packed["row"].eqNullSafe(ones["of"])).select(
            F.col("class").alias("id"), "data").dropDuplicates(["id"])
        sets = stored(_sets(texts), folder)
        met = cells.where("id <> leader").select(F.col("leader").alias("a"), F.col("id").alias("b"))
        found = cut(components(_verified(_close(met.distinct(), signs, percent), sets, percent)))
        # a cell of one component is done, and the one pair of a cell of two has been looked at
        open_ = _placed(cells.where("n > 2").select("id", "cell"), found)
        split = open_.groupBy("cell").agg(
            F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
        open_ = stored(open_.join(split.select("cell"), "cell"), folder)
        some = stored(sets.join(open_.select("id").distinct(), "id", "left_semi"), folder)
        met_by = cells.groupBy("id").agg(F.sum("n").alias("met"))
        leaders = open_.join(met_by, "id").groupBy("cell").agg(F.max_by(
            F.struct("id", "component"), F.struct("met", "id")).alias("l"))
        met = open_.join(leaders, "cell").where(F.col("component") != F.col("l.component")).select(
            F.least("l.id", "id").alias("a"), F.greatest("l.id", "id").alias("b")).distinct()
        found = cut(components(_links(found).unionByName(_verified(_close(met, signs, percent), some, percent))))
        open_ = _placed(open_.drop("component"), found)
        parts = open_.groupBy("cell", "component").agg(F.count("*").alias("n"))
        mains = parts.groupBy("cell").agg(F.max_by("component", F.struct("n", "component")).alias("main"))
        strays = stored(open_.join(mains, "cell").where("component <> main").select("id").distinct(), folder)
        near = stored(_placed(signs.join(some.select("id"), "id", "left_semi"), found).select(
            "id", "component", "sketch", "left"), folder)
        last = _verified(_stray_links(near, strays, some, percent, folder), some, percent)
        final = components(_links(found).unionByName(last)).select(F.col("node").alias("id"), "component")
        linked = heads.select("id", "low").join(final, "id")
        least = linked.groupBy("component").agg(F.min("low").alias("least"))
        named = cut(heads.select("id", "whole", "low").join(
            linked.select("id", "component").join(least, "component").select("id", "least"), "id", "left").select(
            "whole", F.coalesce("least", "low").alias("component")))
    return signed.join(named, "whole", "left").select(
        "id", "row", "n", F.coalesce("component", "id").alias("component"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    percent: int = 75) -> DataFrame:
    """Every row with ``n_shingles``, ``component_id`` (the smallest id that links reach) and ``kept``
    (whether it is its own component's id).

    A NULL or empty text and one of blanks only has no shingles and is linked with nothing. Rows that share an id are
    told apart by their texts; each has its own text's component. A NULL id is kept unless an equal or near text has
    one. Ids may be of any type that has an order. An empty table stays empty. Extra columns pass through; ones named
    like an added column are replaced."""
    df = without(df, "n_shingles", "component_id", "kept")
    row, key, size, component = (free_name(df, c) for c in ("_row", "_key", "_n", "_component"))
    found = classes(df, id_col, text_col, percent)
    told = found.select(F.col("id").alias(key), F.col("row").alias(row), F.col("n").alias(size), F.col(
        "component").alias(component)).dropDuplicates([key, row])
    cols = [F.col(f"`{c}`") for c in df.columns]
    own = df.withColumn(row, F.xxhash64(f"`{text_col}`"))
    out = own.join(told, own[row].eqNullSafe(told[row]) & own[f"`{id_col}`"].eqNullSafe(told[key]))
    return out.select(
        *cols, F.col(size).alias("n_shingles"), F.col(component).alias("component_id"),
        F.col(f"`{id_col}`").eqNullSafe(F.col(component)).alias("kept"))

"""Hard negatives, periodic runs and chat formatting against brute force and exact round trips."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from docframe.llm import chat, negatives, periodic
from docframe.llm.common import read
from docframe.llm.queries import QUERIES

CLASH = ["runs", "Collapsed", "n_words", "key", "ID", "score", "formatted", "turns", "t", "cell_row", "anchor"]

# ---- 11: hard negatives


def brute_negatives(rows, anchor, count=5, low=80, high=100, scale=256):
    width = max([len(v) for *_, v in rows if v is not None], default=0)
    known = []
    for i, label, v in rows:
        if label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        known.append((i, label, [int(np.floor(scale * x)) for x in v] + [0] * (width - len(v))))
    last = float("inf")
    out = []
    for k, (i, label, v) in enumerate(known):
        if i is None or not anchor(i):
            continue
        scored = sorted(((-sum(a * b for a, b in zip(v, w)), last if j is None else j, j, of == label)
                         for m, (j, of, w) in enumerate(known) if m != k), key=lambda s: s[:2])
        for p, _, positive, _ in [s for s in scored if s[3]][:count]:
            fit = [s for s in scored if not s[3] and low * -p <= 100 * -s[0] <= high * -p]
            out += [(i, positive, n + 1, j, -p, -s) for n, (s, _, j, _) in enumerate(fit[:count])]
    return sorted(out, key=str)


def mined(df, anchors, **more):
    return sorted(map(tuple, negatives.mine(df, anchors, **more).collect()), key=str)


VECTORS = "vec_id long, label int, embedding array<float>"


@pytest.mark.parametrize("width,spread", [(3, 1.0), (20, 0.2), (64, 0.1)])
def test_negatives_are_those_of_brute_force(spark, monkeypatch, width, spread):
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 64)
    monkeypatch.setattr(negatives, "BLOCK_ANCHORS", 8)
    rng = np.random.default_rng(width)
    rows = []
    for i in range(700):
        base = np.zeros(width) + (1 if i % 3 else -1) * (np.arange(width) < 4)
        v = np.round(base * rng.random() + spread * rng.standard_normal(width), 1)
        rows.append((i, int(rng.integers(0, 4)), [float(np.float32(x)) for x in v]))
    rows += [(800 + i, i % 2, rows[0][2]) for i in range(200)]  # a third as common as it gets: ties by id
    df = spark.createDataFrame(rows, VECTORS).repartition(5)
    want = brute_negatives(rows, lambda i: i % 20 == 0)
    assert mined(df, F.col("vec_id") % 20 == 0) == want and len(want) > 50


def test_negatives_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [1.0, 0.5]), (0, 1, [1.0, 0.5]), (1, 1, [0.9, 0.5]), (2, 2, [0.9, 0.4]), (3, 2, [0.9]),
            (4, None, [1.0, 0.5]), (5, 2, None), (6, 2, [None, 1.0]), (7, 2, [nan, 1.0]), (8, 2, [inf, 0.0]),
            (9, 2, []), (None, 2, [0.9, 0.4]), (None, None, None), (10, 3, [0.0, 0.0]), (20, 3, [-1.0, -1.0]),
            (30, 4, [0.0, 0.0]), (40, 4, [0.0, 0.0]), (2, 2, [0.9, 0.4])]
    df = spark.createDataFrame(rows, VECTORS).withColumns({c: F.lit("own") for c in CLASH})
    want = brute_negatives(rows, lambda i: i % 10 == 0)
    assert mined(df, F.col("vec_id") % 10 == 0) == want and len(want) > 5
    assert mined(df.limit(0), F.col("vec_id") % 10 == 0) == []
    assert mined(df, F.lit(None).cast("boolean")) == []


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(1)
    rows = [(i, i % 2, [float(x) for x in rng.integers(-1 << 20, 1 << 20, 40000 if i < 2 else 30)])
            for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    assert mined(df, F.col("vec_id") % 10 == 0, scale=1) == brute_negatives(
        rows, lambda i: i % 10 == 0, scale=1)


def test_index_leaves_out_dimensions_and_loses_no_pair():
    rng = np.random.default_rng(3)
    x = np.floor(100 * rng.standard_normal((300, 40)) * np.geomspace(8, 0.1, 40))
    q = np.floor(100 * rng.standard_normal((20, 40)) * np.geomspace(8, 0.1, 40))
    exact = q @ x.T
    for share in (0.5, 0.9, 0.99):
        least = np.quantile(exact, share, axis=1)
        index = negatives.Index(x, negatives._lowest(least, q))
        a, r, s = index.reach(q, least)
        want = {(i, j) for i, j in zip(*np.nonzero(exact >= least[:, None]))}
        assert set(zip(a, r)) == want and (s == exact[a, r]).all()
    assert sum(map(len, index.held)) < 0.8 * len(x) * len(index.groups)


# ---- 12: periodic runs


def brute_runs(words, min_length=6, min_exponent=4):
    out = []
    for q in range(1, len(words) // min_exponent + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(min_length, min_exponent * q) and not any(
                    s <= i and i + length <= s + n for s, n, _ in out):
                out.append((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    return " ".join(w for k, w in enumerate(words) if not any(s + q <= k < s + n for s, n, q in runs))


def words_of(text):
    return [w.decode() for w in (text or "").encode().split()]


@pytest.mark.parametrize("least", [(6, 4), (2, 3), (9, 5)])
def test_runs_are_those_of_brute_force(spark, least):
    rng = random.Random(least[0])
    texts = []
    for _ in range(250):
        words = [f"w{rng.randrange(rng.choice([1, 2, 3, 5, 50]))}" for _ in range(rng.choice([0, 1, 6, 30, 120]))]
        if words and rng.random() < 0.7:
            p, a = rng.randrange(1, max(2, len(words) // 3)), rng.randrange(len(words))
            words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
        texts.append("".join(w + rng.choice([" ", "  ", "\n", "\t", "\x0b"]) for w in words))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for r in periodic.find_runs(df, min_length=least[0], min_exponent=least[1]).collect():
        words = words_of(r["text"])
        want = brute_runs(words, *least)
        assert [tuple(x) for x in r["runs"]] == want
        assert r["n_words"] == len(words) and r["collapsed"] == collapsed(words, want)


def test_runs_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(periodic, "BLOCK", 50)
    long = "a b c " * 60_000
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "x" * 9), (5, "z z z z z z"), (5, "z z z z z z"), (5, "z z z z z"),
            (None, "z z z z z z"), (None, None), (6, long), (7, "é\xa0é é\xa0é é\xa0é é\xa0é é\xa0é é\xa0é")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = periodic.find_runs(df).collect()
    assert sorted(len(r["runs"]) for r in out) == [0] * 6 + [1] * 5
    found = {r["doc_id"]: [tuple(x) for x in r["runs"]] for r in out if r["doc_id"] in (6, 7)}
    assert found == {6: [(0, 180_000, 3)], 7: [(0, 6, 1)]}
    assert all(r["collapsed"] is not None for r in out)
    wide = periodic.find_runs(df.withColumns({c: F.lit("own") for c in CLASH}))
    assert len({c.lower() for c in wide.columns}) == len(wide.columns)
    assert sorted(map(str, wide.select("runs", "collapsed").collect())) == sorted(
        str(r) for r in periodic.find_runs(df).select("runs", "collapsed").collect())
    assert periodic.find_runs(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        periodic.find_runs(df, min_exponent=2)


def test_runs_query_against_brute_force(spark, sf):
    out = {r["doc_id"]: r for r in QUERIES["op12_periodic_runs"](spark, sf).collect()}
    docs = read(spark, sf, "documents").collect()
    assert len(out) == len(docs)
    for d in docs:
        words = words_of(d["text"])
        h = zlib.crc32(str(d["doc_id"]).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
        runs = brute_runs(words) if n < 2500 else None
        r = out[d["doc_id"]]
        if runs is None:
            continue
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        want = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        assert (r["start"], r["length"], r["period"], r["exponent_milli"]) == want
        assert r["n_runs"] == len(runs)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()


# ---- 13: chat formatting

TURNS = "conv_id long, turn long, role string, text string"


def test_chats_come_back_exactly(spark):
    rng = random.Random(4)
    bits = ["<", "|", "\\", ">", "im_end", "<|im_end|>", "<|im_sep|>", "<|im_start|>", "<|endoftext|>", "<\\|", " ",
            "\n", "é", "中", "\U0001f600", "ok", "\n\n", "assistant"]
    rows, want = [], {}
    for c in range(200):
        for t in range(rng.randrange(1, 6)):
            role = rng.choice(["system", "user", "assistant", "assistant", "<|im_sep|>", ""])
            text = rng.choice([None, ""]) if rng.random() < 0.1 else "".join(rng.choices(bits, k=rng.randrange(12)))
            rows.append((c, t, role, text))
            want.setdefault(c, []).append((role, text or ""))
    rng.shuffle(rows)
    formatted = chat.format_chats(spark.createDataFrame(rows, TURNS).repartition(4))
    back = {r["conv_id"]: r for r in chat.read_back(formatted).collect()}
    assert set(back) == set(want)
    for c, turns in want.items():
        assert [tuple(t) for t in back[c]["turns"]] == turns
        assert back[c]["loss_text"] == "".join(x for role, x in turns if role == "assistant")
    own = chat.tokenizer(open(chat.TOKENIZER).read())
    for r in formatted.collect():
        assert back[r["conv_id"]]["formatted_chars"] == len(r["formatted"])
        assert len(r["input_ids"]) == len(r["loss_mask"]) == len(r["token_starts"]) == len(r["token_ends"])
        assert r["token_starts"][0] == 0 and r["token_ends"][-1] == len(r["formatted"])
        assert r["token_starts"] == sorted(r["token_starts"])
        assert own.decode(r["input_ids"], skip_special_tokens=False) == r["formatted"]
        learned = own.decode([i for i, m in zip(r["input_ids"], r["loss_mask"]) if m], skip_special_tokens=False)
        said = [x for role, x in want[r["conv_id"]] if role == "assistant"]
        assert learned == "".join(re.sub(r"<(\\*)\|", r"<\\\1|", x) for x in said)


def test_odd_conversations(spark):
    rows = [(None, 1, "user", "a"), (None, 0, None, None), (1, None, "assistant", "b"), (1, 0, "user", "c"),
            (1, 0, "user", "c"), (2, 0, "assistant", ""), (3, 0, "assistant", "word " * 50_000)]
    df = spark.createDataFrame(rows, TURNS).withColumns({c: F.lit("own") for c in CLASH})
    back = {r["conv_id"]: r for r in chat.read_back(chat.format_chats(df)).collect()}
    assert [tuple(t) for t in back[None]["turns"]] == [("", ""), ("user", "a")]
    assert [tuple(t) for t in back[1]["turns"]] == [("assistant", "b"), ("user", "c"), ("user", "c")]
    assert back[1]["loss_text"] == "b" and back[2]["loss_text"] == ""
    assert back[3]["loss_text"] == "word " * 50_000
    assert chat.format_chats(df.limit(0)).collect() == []


def test_spans_are_met_by_binary_search():
    starts, ends = np.array([0, 3, 3, 5, 9, 12]), np.array([3, 5, 5, 9, 12, 12])
    got = chat.covered(starts, ends, np.array([1, 9, 30]), np.array([4, 10, 31]))
    assert got.tolist() == [True, True, True, False, True, False]
    assert not chat.covered(starts, ends, np.array([], int), np.array([], int)).any()

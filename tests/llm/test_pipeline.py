"""The pipeline's stages against plain Python over the same rows."""

import collections
import hashlib
import itertools
import math
import re

import corpus_pipeline
from docframe.llm.common import read


def test_stages_equal_plain_python(spark, sf, tmp_path):
    docs, tables = read(spark, sf, "documents"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        tables.append([r.asDict() for r in docs.collect()])
    first = [r.asDict() for r in read(spark, sf, "documents").collect()]
    told, alone, clean, mixed, sharded = tables

    lettered = {r["doc_id"] for r in first if re.search(r"[^\W\d_]", r["text"] or "")}
    kept = {r["doc_id"] for r in told}
    assert kept <= lettered and len(kept) >= 0.99 * len(lettered)

    sets = {}
    for r in told:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r["text"]))
        sets[r["doc_id"]] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            lo, hi = sorted((find(a), find(b)))
            root[hi] = lo
    assert {r["doc_id"] for r in alone} == {i for i in sets if find(i) == i}

    items = [r["text"] for r in read(spark, sf, "benchmark").collect()]
    leaks = {r["doc_id"] for r in alone if any(x in r["text"] for x in items)}
    gone = {r["doc_id"] for r in alone} - {r["doc_id"] for r in clean}
    assert leaks <= gone and len(gone) <= len(leaks) + 0.01 * len(alone)

    size = collections.Counter()
    for r in clean:
        size[r["source"]] += len(r["text"].encode()) + 1
    weight = {s: n ** 0.5 for s, n in size.items()}
    copies = collections.Counter(r["doc_id"] for r in mixed)
    for r in clean:
        rate = sum(size.values()) * weight[r["source"]] / sum(weight.values()) / size[r["source"]]
        u = int(hashlib.md5(f"mix|{r['doc_id']}".encode()).hexdigest()[:13], 16) / 2 ** 52
        n, p, c = 0, math.exp(-rate), math.exp(-rate)
        while c <= u:
            n += 1
            p *= rate / n
            c += p
        assert copies[r["doc_id"]] == n
    assert set(copies) <= {r["doc_id"] for r in clean}

    assert collections.Counter(r["doc_id"] for r in sharded) == copies
    by = collections.defaultdict(list)
    for r in sharded:
        by[r["shard"]].append(r["slot"])
    counts = [len(by[s]) for s in range(24)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(x) == list(range(len(x))) for x in by.values())


def test_run_gives_the_last_stage(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    assert out.columns[-2:] == ["shard", "slot"] and out.count() > 0

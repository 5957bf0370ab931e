"""Every operator and stage over nulls, empty and long texts, ties, repeated rows, empty tables and
columns whose names clash with its own."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from docframe.llm import (
    decontamination, language, lines, mixing, neardup, passages, pii, quality, sharding, substrings,
)

LONG = " ".join(f"word{i % 997}x{i}" for i in range(30_000))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog near the old river bank today", "en", "a", 1),
    (2, None, None, None, None),
    (3, "", "en", "a", 0),
    (4, "   \n\t \x0b ", None, "a", 3),
    (5, "one", "fr", "b", 3),
    (5, "one", "fr", "b", 3),
    (6, LONG, "en", "b", 4),
    (7, "Same text here\nand there\nand so on\nfor long", "en", "b", 5),
    (8, "Same text here\nand there\nand so on\nfor long", "en", "b", 5),
    (None, "No id but mail me at a.b@mail.example.com or 10.1.2.3 now", "de", None, 6),
    (None, None, None, None, None),
    (9, "éß \U0001f600 中文 12345", "zh", "c", 7),
]
CLASH = ["copy", "Copies", "position", "Shard", "slot", "entities", "lang_pred", "Score", "_row",
         "component_id", "kept", "lines", "removed_lines", "_key", "n_shingles", "id", "_bucket"]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame(
        [(1, "quick brown fox jumps over the lazy dog"), (2, None), (3, ""), (None, "x y")],
        "item_id long, text string")


@pytest.fixture(scope="module")
def operators(bench):
    return {
        "pii": lambda d: pii.replace(d),
        "mix": lambda d: mixing.mix(d, mixing.rates(d), buckets=16),
        "judge": lambda d: quality.judge(d),
        "keep_good": lambda d: quality.keep_good(d),
        "language": lambda d: language.identify(d, language.fit(d)),
        "shard": lambda d: sharding.shard(d, shards=3, partitions=2, buckets=16),
        "near": lambda d: neardup.near_duplicates(d),
        "substrings": lambda d: substrings.remove_repeats(d),
        "passages": lambda d: passages.mark_repeats(d),
        "leaks": lambda d: decontamination.contaminated(d, bench),
        "decontaminate": lambda d: decontamination.decontaminate(d, bench),
        "lines": lambda d: lines.dedup_lines(d),
    }


NAMES = ["pii", "mix", "judge", "keep_good", "language", "shard", "near", "substrings", "passages",
         "leaks", "decontaminate", "lines"]
ONE_EACH = {"pii", "judge", "language", "shard", "near", "substrings", "passages", "lines"}


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows(operators, table, name):
    rows = operators[name](table).collect()
    if name in ONE_EACH:
        assert len(rows) == len(ROWS)
    assert sorted(map(str, rows)) == sorted(map(str, operators[name](table.repartition(5)).collect()))


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(operators, spark, name):
    assert operators[name](spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("name", NAMES)
def test_clashing_columns(operators, table, name):
    wide = table.where("doc_id < 6 or doc_id is null").withColumns({c: F.lit("own") for c in CLASH})
    plain = operators[name](table.where("doc_id < 6 or doc_id is null"))
    out = operators[name](wide)
    assert len({c.lower() for c in out.columns}) == len(out.columns)
    assert out.count() == plain.count()


def test_stages_keep_the_columns_and_survive_odd_rows(spark, table, bench, tmp_path):
    folder = str(tmp_path / "sf")
    table.write.parquet(f"{folder}/documents.parquet")
    bench.write.parquet(f"{folder}/benchmark.parquet")
    for rows in (table, spark.createDataFrame([], SCHEMA)):
        docs = rows
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, folder)
            if k < len(corpus_pipeline.STAGES) - 1:
                assert out.columns == table.columns
            out.write.mode("overwrite").parquet(f"{folder}/stage{k}")
            docs = spark.read.parquet(f"{folder}/stage{k}")
    assert docs.count() == 0


def test_items_without_or_with_repeated_ids_are_all_searched(spark):
    texts = [" ".join(f"w{k}x{i}" for i in range(30)) for k in range(5)]
    items = [(7, texts[0]), (7, texts[1]), (None, texts[2]), (None, texts[3]), (8, texts[4]), (9, texts[4]),
             (9, texts[4])]
    docs = spark.createDataFrame([(k, f"some {t} more") for k, t in enumerate(texts)], "doc_id long, text string")
    items = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.contaminated(docs, items, block_words=60).collect()
    assert sorted(((r["id"], r["item"]) for r in found), key=str) == sorted(
        [(0, 7), (1, 7), (2, None), (3, None), (4, 8), (4, 9), (4, 9)], key=str)
    assert not decontamination.decontaminate(docs, items).count()

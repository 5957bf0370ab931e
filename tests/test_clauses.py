"""Clauses: missing values, composition, fuzzy distance, phrases, geo."""

import itertools
import random

import duckdb
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from docframe.functions import text as tx
from docframe.operators import clauses as c
from docframe.operators.ranking import search
from docframe.spec import Field, Spec


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(
        [(1, "alpha beta gamma", 5, ["a", "b"], 1.0), (2, None, None, None, None),
         (3, "beta alpha", 7, [], 2.0), (4, "alpha x y gamma", 9, ["c"], 3.0),
         (5, "", 5, [None], None)],
        "id int, text string, n int, tags array<string>, v double")


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_missing_values_do_not_hold_and_are_kept_by_must_not(rows):
    for clause in (c.range_("n", gt=5), c.term("n", 5), c.terms("n", [5, 7]),
                   c.prefix("text", "alpha"), c.wildcard("text", "a*"), c.match("text", "alpha"),
                   c.match_phrase("text", "alpha beta"), c.exists("n")):
        hit, miss = ids(search(rows, clause)), ids(search(rows, c.bool_(must_not=[clause])))
        assert 2 not in hit and 2 in miss
        assert sorted(hit + miss) == [1, 2, 3, 4, 5]
        assert ids(search(rows, c.bool_(must=[clause], must_not=[clause]))) == []


def test_exists_on_lists(rows):
    assert ids(search(rows, c.exists("tags", is_list=True))) == [1, 4, 5]


def test_match_operators(rows):
    assert ids(search(rows, c.match("text", "BETA gamma"))) == [1, 3, 4]
    assert ids(search(rows, c.match("text", "beta gamma", operator="and"))) == [1]
    assert ids(search(rows, c.match("n", 5))) == [1, 5]
    assert ids(search(rows, c.match("text", "!!", zero_terms_query="all"))) == [1, 2, 3, 4, 5]
    assert ids(search(rows, c.match("text", "!!"))) == []


def test_match_only_whole_tokens(spark):
    df = spark.createDataFrame([(1, "alphabet"), (2, "an alpha"), (3, "alpha-bet")],
                               "id int, text string")
    assert ids(search(df, c.match("text", "alpha"))) == [2, 3]


def test_phrase_and_slop(rows):
    assert ids(search(rows, c.match_phrase("text", "alpha gamma"))) == []
    assert ids(search(rows, c.match_phrase("text", "alpha gamma", slop=1))) == [1]
    assert ids(search(rows, c.match_phrase("text", "alpha gamma", slop=2))) == [1, 4]
    assert ids(search(rows, c.match_phrase_prefix("text", "alpha be"))) == [1]


@pytest.mark.parametrize("analyzer", ["standard", "english"])
@pytest.mark.parametrize("phrase,slop", [
    ("x y", 0), ("x y", 1), ("x y", 3), ("x x", 2), ("x y z", 1), ("x y z", 2), ("x y x", 2), ("y x xx", 3),
    ("z z z", 1)])
def test_slop_against_brute_force(spark, analyzer, phrase, slop):
    rng = random.Random(len(phrase) * 10 + slop)
    docs = [[rng.choice(["x", "y", "z", "xx", "yx"]) for _ in range(rng.randrange(14))] for _ in range(300)]
    df = spark.createDataFrame([(i, "".join(w + rng.choice([" ", ", ", "-"]) for w in words))
                                for i, words in enumerate(docs)], "id int, text string")
    wanted = phrase.split()

    def holds(words):
        return any(
            all(words[i] == p for i, p in zip(pos, wanted)) and pos[-1] - pos[0] - (len(wanted) - 1) <= slop
            for pos in itertools.combinations(range(len(words)), len(wanted)))

    got = ids(search(df, c.match_phrase("text", phrase, analyzer=analyzer, slop=slop)))
    assert got == [i for i, words in enumerate(docs) if holds(words)]


@pytest.mark.parametrize("fuzziness,prefix,swaps", [("auto", 0, True), ("auto", 1, False), (2, 0, True), (1, 0, True),
                                                    (2, 2, True), (0, 0, True)])
def test_many_fuzzy_terms_against_brute_force(spark, fuzziness, prefix, swaps):
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("abé") for _ in range(rng.randrange(1, 9))) for _ in range(260)})
    queries = sorted({"".join(rng.choice("abé") for _ in range(rng.randrange(1, 9))) for _ in range(60)})
    df = spark.createDataFrame([(w,) for w in [*words, *words[:9], None]], "w string").repartition(3)
    asked = spark.createDataFrame([(q,) for q in [*queries, queries[0], None]], "q string")
    name = "damerau_levenshtein" if swaps else "levenshtein"
    want = set()
    con = duckdb.connect()
    for q, w, d in con.execute(f"SELECT q, w, {name}(translate(q, 'é', 'e'), translate(w, 'é', 'e')) "
                               "FROM (SELECT unnest(?) AS q), (SELECT unnest(?) AS w)", [queries, words]).fetchall():
        limit = (0 if len(q) <= 2 else 1 if len(q) <= 5 else 2) if fuzziness == "auto" else fuzziness
        if d <= limit and q[:prefix] == w[:prefix]:
            want.add((q, w, d))
    got = c.near_terms(df, "w", asked, "q", fuzziness, prefix, transpositions=swaps)
    assert {tuple(r) for r in got.collect()} == want and len(want) >= 10
    some = c.near_terms(df, "w", asked, "q", fuzziness, prefix, 2, swaps).collect()
    best = {}
    for q, w, d in sorted(want, key=lambda x: (x[0], x[2], x[1])):
        best.setdefault(q, []).append((q, w, d))
    assert {tuple(r) for r in some} == {x for found in best.values() for x in found[:2]}


def test_fuzzy_hits_are_rows_with_a_near_term(spark):
    df = spark.createDataFrame([(1, "red house"), (2, "huose hose"), (3, None), (4, "green")], "id int, text string")
    asked = spark.createDataFrame([("house",), ("gren",)], "q string")
    got = c.fuzzy_hits(df, "text", "id", asked, "q").collect()
    assert sorted(map(tuple, got)) == [("gren", 4, 1), ("house", 1, 0), ("house", 2, 1)]


def test_text_clauses_on_list_elements(spark):
    df = spark.createDataFrame([(1, ["red fox", "blue dog"]), (2, ["red dog"]), (3, None)],
                               "id int, lines array<string>")
    both = c.any_element("lines", lambda x: c.match(x, "red dog", operator="and"))
    assert ids(search(df, both)) == [2]
    assert ids(search(df, c.any_element("lines", lambda x: c.match_phrase(x, "red fox")))) == [1]


def test_word_tests_agree_with_tokens(spark):
    """Tests on the text give what tests on its token list give."""
    rng = random.Random(4)
    pieces = ["the", "other", "th", "e", "été", "a1", "Straße", "THE", " ", " ", ", ", "-", "_",
              "\n", "'"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 14))) for _ in range(1500)]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    tokens = tx.tokens("text")
    spaced = F.concat(F.lit(" "), F.array_join(tokens, " "), F.lit(" "))
    for word in ("the", "e", "été", "a1", "straße"):
        assert ids(search(df, c.match("text", word))) == ids(
            df.where(F.array_contains(tokens, word)))
        assert ids(search(df, c.match_bool_prefix("text", word))) == ids(
            df.where(spaced.contains(f" {word}")))
    for a, b in (("the", "other"), ("th", "e"), ("e", "e"), ("été", "a1")):
        assert ids(search(df, c.match_phrase("text", f"{a} {b}"))) == ids(
            df.where(spaced.contains(f" {a} {b} ")))
        assert ids(search(df, c.match_phrase_prefix("text", f"{a} {b}"))) == ids(
            df.where(spaced.contains(f" {a} {b}")))
        assert ids(search(df, c.match_phrase("text", f"{a} {b}", slop=2))) == ids(
            df.where(spaced.rlike(f" {a}(?: [^ ]+){{0,2}} {b} ")))


def test_phrases_of_another_analyser(spark):
    df = spark.createDataFrame([(1, "the running dogs"), (2, "dogs run far"), (3, "runs, a dog")],
                               "id int, text string")
    assert ids(search(df, c.match("text", "dog", analyzer="english"))) == [1, 2, 3]
    assert ids(search(df, c.match_phrase("text", "dog run", analyzer="english"))) == [2]
    assert ids(search(df, c.match_phrase("text", "run the dog", 1, "english"))) == [3]


def test_minimum_should_match():
    assert c.needed_matches(2, 4) == 2
    assert c.needed_matches("-1", 4) == 3
    assert c.needed_matches("70%", 4) == 2
    assert c.needed_matches("-25%", 4) == 3


def test_should_is_optional_beside_must(rows):
    assert ids(search(rows, c.bool_(must=[c.term("n", 5)], should=[c.term("id", 1)]))) == [1, 5]
    assert ids(search(rows, c.bool_(should=[c.term("id", 1)]))) == [1]


def test_boost_and_bool_scores(rows):
    clause = c.bool_(must=[c.exists("n", boost=2)], should=[c.term("id", 1, boost=3)],
                     filter=[c.range_("n", gte=5)], boost=10)
    got = {r["id"]: r["_score"] for r in search(rows, clause, scored=True).collect()}
    assert got == {1: 50.0, 3: 20.0, 4: 20.0, 5: 20.0}


def test_edit_distance_matches_damerau(spark):
    rng = random.Random(5)
    words = list({"".join(rng.choice("abcd") for _ in range(rng.randint(1, 6)))
                  for _ in range(700)})
    df = spark.createDataFrame([(w,) for w in words], "w string")
    con = duckdb.connect()
    con.execute("CREATE TABLE t(w VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?)", [(w,) for w in words])
    for value in ("abcd", "ba", "dcab", "aabbc", "a", "cabdac"):
        for limit in (1, 2):
            got = {(r["w"], r["d"]) for r in df.select(
                "w", c.edit_distance(F.col("w"), value, limit).alias("d")).collect()
                if r["d"] is not None}
            want = {(w, d) for w, d in con.execute(
                "SELECT w, damerau_levenshtein(w, ?) FROM t", [value]).fetchall() if d <= limit}
            assert got == want, (value, limit)


def test_fuzzy_expansions_keep_the_closest(spark):
    df = spark.createDataFrame([(1, "ring"), (2, "rang"), (3, "rings"), (4, "song")],
                               "id int, text string")
    assert ids(search(df, c.fuzzy(df, "text", "ring", 1))) == [1, 2, 3]
    assert ids(search(df, c.fuzzy(df, "text", "ring", 1, max_expansions=2))) == [1, 2]
    assert ids(search(df, c.fuzzy(df, "text", "ring", 1, max_expansions=None))) == [1, 2, 3]
    assert ids(search(df, c.fuzzy(df, "text", "ring", 1, prefix_length=2))) == [1, 3]
    assert c.fuzzy_limit("ab", "auto") == 0 and c.fuzzy_limit("abcde", "auto") == 1
    assert c.fuzzy_limit("abcdef", "auto") == 2


def test_geo_box_never_cuts_a_near_point(spark):
    rng = random.Random(3)
    pts = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(3000)]
    df = spark.createDataFrame(pts, "id int, lat double, lon double")
    from docframe.functions.geo import haversine_km

    for lat, lon, km in ((0, 0, 900), (70, 10, 1500), (-89, 5, 700), (20, 179, 1200),
                         (45, -179.5, 4000), (10, 20, 12000)):
        want = ids(df.where(haversine_km(F.col("lat"), F.col("lon"), lat, lon) <= km))
        got = ids(search(df, c.geo_distance("lat", "lon", {"lat": lat, "lon": lon}, f"{km}km")))
        assert got == want


def test_geo_validation(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.0, 360.0), (3, None, 0.0)],
                               "id int, lat double, lon double")
    at = {"lat": 0, "lon": 0}
    assert ids(search(df, c.geo_distance("lat", "lon", at, "1km"))) == [1]
    assert ids(search(df, c.geo_distance("lat", "lon", at, "1km",
                                         validation_method="coerce"))) == [1, 2]
    assert ids(search(df, c.geo_distance("lat", "lon", at, "1km", distance_type="plane"))) == [1]
    with pytest.raises(ValueError):
        c.geo_distance("lat", "lon", {"lat": 95, "lon": 0}, "1km")


def test_query_analysis_agrees_with_columns(spark):
    texts = ["The ponies' running-shoes", "Él camión_rojo 42nd", "boxes ties glasses bus",
             "stopped sing bring", "ÄÖÜ straße"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for name in ("standard", "english"):
        got = [r["x"] for r in df.select(tx.ANALYZERS[name]("t").alias("x")).collect()]
        assert got == [tx.analyse_query(t, name) for t in texts]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.text(alphabet="st?*.[a\\", max_size=6))
def test_wildcard_against_fnmatch(spark, pattern):
    import itertools

    words = ["".join(p) for n in range(4) for p in itertools.product("sta.", repeat=n)]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = {r["w"] for r in search(df, c.wildcard("w", pattern)).collect()}

    def holds(p, w):
        if not p:
            return not w
        if p[0] == "*":
            return any(holds(p[1:], w[i:]) for i in range(len(w) + 1))
        return bool(w) and (p[0] == "?" or p[0] == w[0]) and holds(p[1:], w[1:])

    assert got == {w for w in words if holds(pattern, w)}


def test_declared_kinds_decide(spark):
    spec = Spec("d", (
        Field("seg"), Field("body", "text"), Field("tags", many=True), Field("n", "long"),
        Field("hidden", index=False),
        Field("items", "nested", fields=(Field("q", "integer"), Field("note", "text")))))
    df = spark.createDataFrame([
        (1, "BUILDING", "A small Building", ["x", "y"], 3, "h", [(1, "red wood"), (2, "old")]),
        (2, "Building", "stone", None, 4, "h", None)],
        "id int, seg string, body string, tags array<string>, n long, hidden string, "
        "items array<struct<q:int,note:string>>")
    on = c.Declared(spec)

    def got(clause):
        return sorted(r["id"] for r in search(df, clause).collect())

    assert got(on.match("seg", "Building")) == [2] and got(on.match("body", "building")) == [1]
    assert got(on.term("tags", "y")) == [1] and got(on.terms("tags", ["q", "x"])) == [1]
    assert got(on.by_fields({"body": "building small", "seg": "BUILDING", "tags": "x"})) == [1]
    assert got(on.by_fields({"body": "building stone"})) == []
    assert got(on.range_("items.q", gte=2)) == [1] and got(on.match("items.note", "wood")) == [1]
    assert got(on.exists("tags")) == [1] and got(on.exists("items")) == [1]
    for broken in ("hidden", "nope"):
        with pytest.raises(ValueError):
            on.term(broken, "h")


def test_long_phrases_with_much_slop(spark):
    words = [f"w{i}" for i in range(8)]
    text = " z ".join(words[:5]) + " z z z " + " ".join(words[5:])
    df = spark.createDataFrame([(1, text), (2, " ".join(reversed(words))), (3, "w0 w0 w1")],
                               "id int, text string")

    def got(query, slop):
        return [r["id"] for r in search(df, c.match_phrase("text", query, slop)).collect()]

    assert got(" ".join(words), 10) == [1] and got(" ".join(words), 7) == [1]
    assert got(" ".join(words), 6) == [] and got("w0 w0 w1", 3) == [3]


def test_phrase_slop_equals_brute_force(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice("abc") for _ in range(rng.randrange(1, 12)))) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, text string")
    for query, slop in (("a b", 1), ("a b a", 2), ("c c b", 3), ("a a", 0)):
        words = query.split()
        want = []
        for i, text in rows:
            t = text.split()
            ok = any(all(t[q] == w for q, w in zip(place, words))
                     and place[-1] - place[0] - (len(words) - 1) <= slop
                     for place in itertools.combinations(range(len(t)), len(words)))
            want += [i] * ok
        got = sorted(r["id"] for r in search(df, c.match_phrase("text", query, slop)).collect())
        assert got == want

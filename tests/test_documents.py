"""Specs, ingest, encoding, routing."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from docframe.functions import dates
from docframe.operators import clauses as c
from docframe.operators.ranking import search
from docframe.sources import documents as d
from docframe.sources import ingest, tables
from docframe.spec import REQUIRED, Field, Spec


def one(df, name="x"):
    return df.select(F.col(name)).first()[0]


def test_schema_carries_the_declarations(spark):
    spec = Spec("p", (
        Field("title", "text", alias="t", subfields={"keyword": {}}),
        Field("vec", "dense_vector", None, dims=3, similarity="l2"),
        Field("nums", "long", many=True), Field("u", "unsigned_long"),
        Field("inner", "object", fields=(Field("a", "integer"),)),
        Field("items", "nested", fields=(Field("b", "keyword"),)),
    ))
    s = spec.schema()
    assert s["title"].metadata["alias"] == "t" and s["title"].metadata["subfields"] == ["keyword"]
    assert s["vec"].metadata["dims"] == 3 and s["vec"].metadata["similarity"] == "l2"
    assert s["nums"].dataType.simpleString() == "array<bigint>"
    assert s["u"].dataType.simpleString() == "decimal(20,0)"
    assert s["inner"].dataType.simpleString() == "struct<a:int>"
    assert s["items"].dataType.simpleString() == "array<struct<b:string>>"
    assert spec.field("u").default is REQUIRED


def test_identity(spark):
    df = spark.createDataFrame([(1, "a"), (1001, "b")], "custom_id long, f_str string")
    fields = (Field("custom_id", "long"), Field("f_str"))
    ids = lambda s, x=df, at=None: [r["_id"] for r in s.with_id(x, at).collect()]
    assert ids(Spec("i", fields, id_field="custom_id")) == ["1", "1001"]
    assert ids(Spec("i", fields, id_expr=lambda: F.col("custom_id") + 1000)) == ["1001", "2001"]
    with pytest.raises(ValueError):
        ids(Spec("i", fields))
    same = spark.createDataFrame([(i, "A") for i in range(3)], "at long, f_str string")
    named = Spec("i", (Field("f_str"),))
    made = ids(named, same, "at")
    assert {len(x) for x in made} == {20} and len(set(made)) == 3 and made == ids(named, same, "at")
    given = df.withColumn("_id", F.when(F.col("custom_id") == 1, "own"))
    assert ids(Spec("i", fields, id_field="custom_id"), given) == ["own", "1001"]


RULES = Spec("r", (
    Field("n", "integer", gt=0, lt=10, multiple_of=3), Field("w", "byte", None),
    Field("s", "text", None, min_length=2, max_length=4, pattern="^[a-z]+$"),
    Field("u", "unsigned_long", None), Field("e", "keyword", None, allowed=("a", "b")),
    Field("ip", "ip", None), Field("url", "http_url", None), Field("id", "uuid", None),
    Field("p", "geo_point", None), Field("v", "dense_vector", None, dims=2),
    Field("xs", "long", None, many=True, ge=1),
    Field("items", "nested", None, fields=(Field("q", "integer", ge=1),)),
))


def reasons(spark, **values):
    base = {"n": "3"}
    base.update(values)
    cols = [(v if not isinstance(v, str) else F.lit(v)).alias(k) for k, v in base.items()]
    return ingest.validate(spark.range(1).select(*cols), RULES).first()["_reasons"]


def test_rules(spark):
    assert reasons(spark) == []
    assert reasons(spark, n="x") == ["n: type"]
    assert reasons(spark, n=F.lit(None).cast("string")) == ["n: missing"]
    assert reasons(spark, n="12") == ["n: not < 10"] and reasons(spark, n="0") == ["n: not > 0"]
    assert reasons(spark, n="4") == ["n: not a multiple of 3"]
    assert reasons(spark, w="200") == ["w: type"] and reasons(spark, w="100") == []
    assert reasons(spark, s="a") == ["s: shorter than 2"]
    assert reasons(spark, s="ABCDE") == ["s: longer than 4", "s: pattern"]
    assert reasons(spark, s="  abc ") == []
    assert reasons(spark, u="-1") == ["u: negative"]
    assert reasons(spark, u="18446744073709551615") == []
    assert reasons(spark, e="c") == ["e: not allowed"]
    for ok in ("192.0.2.1", "::1", "fe80::1:2", "1:2:3:4:5:6:7:8"):
        assert reasons(spark, ip=ok) == []
    for bad in ("256.1.1.1", "1.2.3", ":::", "1:2:3:4:5:6:7", "g::1"):
        assert reasons(spark, ip=bad) == ["ip: not an ip"]
    assert reasons(spark, url="ftp://x") == ["url: not a http_url"]
    assert reasons(spark, url="https://example.com/a?b") == []
    assert reasons(spark, id="nope") == ["id: not a uuid"]
    point = F.struct(F.lit(91.0).alias("lat"), F.lit(0.0).alias("lon"))
    assert reasons(spark, p=point) == ["p: out of range"]
    assert reasons(spark, v=F.array(F.lit(1.0))) == ["v: not 2 dims"]
    assert reasons(spark, xs=F.array(F.lit(1), F.lit(0))) == ["xs: not >= 1"]
    items = F.array(F.struct(F.lit(1).alias("q")), F.struct(F.lit(0).alias("q")))
    assert reasons(spark, items=items) == ["items.q: not >= 1"]


def test_conform_defaults_aliases_and_refusals(spark):
    spec = Spec("c", (Field("f_int", "long", 0), Field("f_str", "keyword", "a", alias="f_str_alias")))
    df = spark.createDataFrame([("7", " x "), (None, None)], "f_int string, f_str_alias string")
    assert [tuple(r) for r in ingest.conform(df, spec).collect()] == [(7, "x"), (0, "a")]
    with pytest.raises(ValueError, match="unknown"):
        ingest.conform(df.withColumn("z", F.lit(1)), spec)
    valid, rejected = ingest.split_valid(df.withColumn("f_int", F.lit("q")), spec)
    assert valid.count() == 0 and rejected.first()["_reasons"] == ["f_int: type"]
    some = d.select_fields(spark.createDataFrame([(5, "b")], "f_int long, f_str string"), spec,
                           ["f_int"])
    assert tuple(some.first()) == (5, "a")


def test_evolution_adds_and_refuses(spark):
    old = spark.createDataFrame([(1, "a")], "id int, s string")
    new = spark.createDataFrame([(2, 9, 1.5)], "id int, s int, extra double")
    merged, refused = ingest.evolve(old, new)
    assert sorted(map(tuple, merged.collect())) == [(1, "a", None), (2, None, 1.5)]
    assert refused == [("s", "string", "int")]


STORED = Spec("s", (
    Field("id", "keyword"), Field("raw", "binary", None), Field("at", "datetime", None),
    Field("day", "date", None), Field("clock", "time", None), Field("flag", "boolean", True),
    Field("made", "keyword", None, exclude=True),
    Field("items", "nested", None, fields=(Field("when", "datetime", alias="w"),)),
), id_field="id")


def test_documents_round_trip(spark):
    df = spark.sql("""SELECT 'k1' AS id, X'01020304' AS raw,
        timestamp_ntz'2024-01-02 03:04:05.5' AS at, date'2024-01-02' AS day,
        timestamp_ntz'1970-01-01 10:20:30' AS clock, false AS flag, 'm' AS made,
        array(named_struct('when', timestamp_ntz'2024-05-06 00:00:00')) AS items""")
    stored = d.encode(df, STORED)
    row = stored.first()
    assert row["_id"] == "k1"
    assert row["doc"] == (
        '{"raw":"AQIDBA==","at":"2024-01-02T03:04:05.500000Z","day":"2024-01-02",'
        '"clock":"1970-01-01T10:20:30","flag":false,"items":[{"w":"2024-05-06T00:00:00Z"}]}')
    back = d.decode(stored, STORED).first()
    assert bytes(back["raw"]) == b"\x01\x02\x03\x04" and back["id"] == "k1"
    assert back["at"] == datetime(2024, 1, 2, 3, 4, 5, 500000) and back["day"] == date(2024, 1, 2)
    assert back["clock"] == datetime(1970, 1, 1, 10, 20, 30) and back["flag"] is False
    assert back["items"][0]["when"] == datetime(2024, 5, 6) and back["made"] is None
    only = d.decode(stored, STORED, source=["day"]).first()
    assert only["day"] == date(2024, 1, 2) and only["raw"] is None and only["flag"] is True


def test_offsets_are_converted_to_utc(spark):
    df = spark.createDataFrame([("x", '{"at":"2024-01-01T12:00:00+02:00"}'),
                                ("y", '{"at":"2024-01-01T12:00:00"}')], "_id string, doc string")
    got = [r["at"] for r in d.decode(df, STORED).collect()]
    assert got == [datetime(2024, 1, 1, 10), datetime(2024, 1, 1, 12)]
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert [r["at"] for r in d.decode(df, STORED).collect()] == got
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_routes_are_read_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "test1"), (2, "test2"), (3, "test1")], "n int, _routing string")
    tables.write_routed(df, path)
    got = tables.read_routed(spark, path, "test1")
    assert sorted(r["n"] for r in got.collect()) == [1, 3]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_routing" in plan


def test_date_math(spark):
    def at(e, now="2024-03-31 10:20:30"):
        return spark.range(1).select(dates.date_math(e, now).alias("x")).first()[0]

    assert at("now") == datetime(2024, 3, 31, 10, 20, 30)
    assert at("now-3630s") == datetime(2024, 3, 31, 9, 20)
    assert at("now-1M/M") == datetime(2024, 2, 1)
    assert at("now/w") == datetime(2024, 3, 25)
    assert at("now+1y-1d/d") == datetime(2025, 3, 30)
    assert at("2024-01-31||+1M") == datetime(2024, 2, 29)
    with pytest.raises(ValueError):
        dates.date_math("now+1", "2024-01-01")
    assert dates.duration_micros("-1d") == -86_400_000_000


def test_predicates_reach_the_scan(spark, sf):
    lines = spark.read.parquet(f"{sf}/lineitem.parquet")

    def pushed(clause):
        plan = search(lines, clause).select("l_orderkey")._jdf.queryExecution()
        text = plan.executedPlan().toString()
        return text.split("PushedFilters: [")[1].split("],")[0]

    assert "GreaterThan(l_quantity,10.0)" in pushed(c.range_("l_quantity", gt=10))
    assert "In(l_returnflag" in pushed(c.terms("l_returnflag", ["A", "R"]))
    assert "StringStartsWith(l_returnflag,A)" in pushed(c.wildcard("l_returnflag", "A*"))
    assert "Not(EqualTo(l_returnflag,A))" in pushed(c.bool_(must_not=[c.term("l_returnflag", "A")]))
    shipped = c.range_("l_shipdate", gte="now-1y/d", now="1998-01-01 00:00:00")
    assert "GreaterThanOrEqual(l_shipdate,1997-01-01T00:00)" in pushed(shipped)


def test_text_filters_stay_on_the_jvm(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for clause in (c.match("text", "the of", operator="and"), c.match_phrase("text", "of the", 2)):
        plan = search(docs, clause, scored=True)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Exchange hash" not in plan


def test_ranked_search_reads_only_its_column(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    plan = search(docs, c.match("text", "the"), scored=True).select("doc_id", "_score")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<text:string>" in text
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text


def test_objects_conform_by_name(spark):
    spec = Spec("o", (Field("o", "object", fields=(
        Field("a", "integer"), Field("b", "keyword", None, alias="bee"),
        Field("c", "keyword", default="none"))),
        Field("l", "nested", None, fields=(Field("x", "long"), Field("y")))))
    df = spark.sql("""SELECT named_struct('bee', ' blank ', 'a', '10') AS o,
        array(named_struct('y', ' t ', 'x', '7')) AS l""")
    r = ingest.conform(df, spec).first()
    assert r["o"].asDict() == {"a": 10, "b": "blank", "c": "none"}
    assert [x.asDict() for x in r["l"]] == [{"x": 7, "y": "t"}]
    with pytest.raises(ValueError):
        ingest.conform(df.withColumn("o", F.col("o").withField("more", F.lit(1))), spec)


DEEP = Spec("deep", (
    Field("o", "object", None, fields=(
        Field("n", "integer", gt=0), Field("p", "geo_point", None),
        Field("in", "object", None, fields=(Field("s", "keyword", max_length=2), Field("d", "date", None))))),
    Field("l", "nested", None, fields=(
        Field("x", "long"), Field("t", "text", None, alias="tt"),
        Field("k", "nested", None, fields=(Field("z", "double", ge=0),)))),
    Field("xs", "long", None, many=True, ge=1), Field("v", "dense_vector", None, dims=2),
))


def test_values_inside_objects_and_lists_are_validated(spark):
    schema = ("id int, o struct<n:string,p:struct<lat:string,lon:string>,`in`:struct<s:string,d:string>>, "
              "l array<struct<x:string,tt:string,k:array<struct<z:string>>>>, xs array<string>, v array<string>")
    rows = [
        (0, None, None, None, None),
        (1, ("1", ("1", "2"), ("ab", "2024-01-01")), [("1", "t", [("0.5",)])], ["1", None], ["1", "2.5"]),
        (2, ("bad", None, None), [], [], None),
        (3, (None, ("x", "2"), ("abc", "no")), None, ["1", "x"], ["1", "y"]),
        (4, ("0", ("1", "200"), None), [("1", None, None), None, ("q", None, [("-1",), ("w",), (None,)]), ("r", None, [])],
         ["0"], ["1"]),
    ]
    df = spark.createDataFrame(rows, schema)
    got = {r["id"]: r["_reasons"] for r in ingest.validate(df, DEEP).collect()}
    assert got == {
        0: [], 1: [], 2: ["o.n: type"],
        3: ["o.n: missing", "o.p: type", "o.in.s: longer than 2", "o.in.d: type", "xs: type", "v: type"],
        4: ["o.n: not > 0", "o.p: out of range", "l.x: type", "l.k.z: not >= 0", "l.k.z: type", "l.k.z: missing",
            "xs: not >= 1", "v: not 2 dims"],
    }
    valid, rejected = ingest.split_valid(df.drop("id"), DEEP)
    assert valid.count() == 2 and rejected.count() == 3
    report = {r["field"]: (r["n_null"], r["n_uncast"], r["n_outside"])
              for r in ingest.schema_report(df, DEEP).collect()}
    assert report == {"o": (1, 2, 2), "l": (2, 1, 1), "xs": (1, 1, 1), "v": (2, 1, 1)}


def test_shapes_that_do_not_fit_are_types(spark):
    df = spark.createDataFrame([(1, [1], "a", [[1]])], "o int, l array<int>, xs string, v array<array<int>>")
    checked = ingest.validate(df, DEEP).first()["_reasons"]
    assert checked[:3] == ["o: type", "l: type", "xs: type"]
    extra = spark.createDataFrame([((1, 5),), (None,)], "o struct<n:int,more:int>")
    assert [r["_reasons"] for r in ingest.validate(extra, DEEP).collect()] == [["o.more: unknown"], []]


def test_evolution_merges_objects_and_lists(spark):
    old = spark.createDataFrame([(1, (1, "a", (1,)), [(1,), None], [1])],
                                "id int, o struct<a:int,b:string,c:struct<d:int>>, l array<struct<x:int>>, p array<int>")
    new = spark.createDataFrame(
        [(2, (True, (2, "e"), 3), [("y", 5)], ["q"]), (3, None, None, None)],
        "ID int, o struct<B:boolean,c:struct<d:int,e:string>,a:int>, l array<struct<y:string,x:int>>, p array<string>")
    merged, refused = ingest.evolve(old, new)
    assert refused == [("o.b", "string", "boolean"), ("p", "int", "string")]
    assert merged.schema.simpleString() == (
        "struct<id:int,o:struct<a:int,b:string,c:struct<d:int,e:string>>,l:array<struct<x:int,y:string>>,p:array<int>>")
    got = {r["id"]: r.asDict(recursive=True) for r in merged.collect()}
    assert got[1]["o"] == {"a": 1, "b": "a", "c": {"d": 1, "e": None}} and got[1]["l"] == [{"x": 1, "y": None}, None]
    assert got[2]["o"] == {"a": 3, "b": None, "c": {"d": 2, "e": "e"}} and got[2]["l"] == [{"x": 5, "y": "y"}]
    assert got[1]["p"] == [1] and got[2]["p"] is None
    assert got[3]["o"] is None and got[3]["l"] is None

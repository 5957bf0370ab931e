"""Typing, checking and splitting incoming rows against a spec."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as tx
from ..spec import STRINGS, SYSTEM, Field, Spec


def _source(df: DataFrame, f: Field) -> str | None:
    return f.stored if f.stored in df.columns else f.name if f.name in df.columns else None


def _value(raw: Column, have: T.DataType, f: Field) -> Column:
    """A present column in the field's declared type. Objects are built field by field, by name or
    alias, so their order in the data does not matter; what is inside is typed alike."""
    if f.kind == "object":
        return _object(raw, have, f)
    if f.kind == "nested":
        return F.transform(raw, lambda x: _object(x, have.elementType, f))
    if f.many:
        if not isinstance(have, T.ArrayType):
            return raw.try_cast(f.type())
        one = replace(f, many=False)
        return F.transform(raw, lambda x: _value(x, have.elementType, one))
    if f.kind == "geo_point" and isinstance(have, T.StructType):
        return F.when(raw.isNotNull(), F.struct(*[
            raw[c].try_cast("double").alias(c) for c in ("lat", "lon")]))
    if f.kind == "binary" and isinstance(have, T.StringType):
        return F.unbase64(raw)
    return F.trim(raw.cast("string")) if f.kind in STRINGS else raw.try_cast(f.type())


def _object(raw: Column, have: T.DataType, f: Field) -> Column:
    if not isinstance(have, T.StructType):
        raise ValueError(f"{f.name} is declared an object but holds {have.simpleString()}")
    known = {s.stored for s in f.fields} | {s.name for s in f.fields}
    extra = [c for c in have.names if c not in known]
    if extra:
        raise ValueError(f"unknown fields in {f.name}: {extra}")
    parts = []
    for s in f.fields:
        name = s.stored if s.stored in have.names else s.name if s.name in have.names else None
        value = F.lit(None).cast(s.type()) if name is None else _value(
            raw[name], have[name].dataType, s)
        if not s.required and s.default is not None:
            value = F.coalesce(value, s.default_column())
        parts.append(value.alias(s.name))
    return F.when(raw.isNotNull(), F.struct(*parts))


def typed(df: DataFrame, f: Field) -> Column:
    """The field's value in its declared type; NULL when absent or not convertible."""
    name = _source(df, f)
    if name is None:
        return F.lit(None).cast(f.type())
    return _value(F.col(name), df.schema[name].dataType, f)


def unknown_columns(df: DataFrame, spec: Spec) -> list[str]:
    known = {f.stored for f in spec.fields} | {f.name for f in spec.fields} | set(SYSTEM)
    return [c for c in df.columns if c not in known]


def conform(df: DataFrame, spec: Spec) -> DataFrame:
    """Declared fields only, typed, trimmed, renamed from their alias, defaults filled in.
    A column the spec does not know is refused."""
    extra = unknown_columns(df, spec)
    if extra:
        raise ValueError(f"unknown fields for {spec.name}: {extra}")
    cols = []
    for f in spec.fields:
        value = typed(df, f)
        if not f.required and f.default is not None:
            value = F.coalesce(value, f.default_column())
        cols.append(value.alias(f.name))
    return df.select(*[c for c in df.columns if c in SYSTEM], *cols)


def _flat(reasons: list[Column]) -> Column:
    return F.flatten(F.array_compact(F.array(F.array().cast("array<string>"), *reasons)))


def _reasons(df: DataFrame, f: Field) -> Column:
    """Everything that is wrong with a declared field, as an array."""
    name = _source(df, f)
    raw = None if name is None else F.col(name)
    return _flat(_checks(f, f.name, raw, None if name is None else df.schema[name].dataType, F.lit(True)))


def _checks(f: Field, path: str, raw: Column | None, have: T.DataType | None, there: Column) -> list[Column]:
    """Arrays of reasons against one value, NULL where there are none. ``raw`` is None if the data lacks the
    field; ``there`` tells whether what holds it is present. Objects and the elements of lists are checked in turn, so
    a path names the innermost field; of a list's elements each distinct reason counts once."""
    out = []

    def note(test: Column, what: str) -> None:
        out.append(F.when(F.coalesce(test, F.lit(False)), F.array(F.lit(f"{path}: {what}"))))

    gone = F.lit(True) if raw is None else raw.isNull()
    fits = raw is None or _fits(f, have)
    if not fits:
        note(raw.isNotNull(), "type")
    elif raw is not None and f.kind not in STRINGS and f.kind not in ("object", "nested"):
        if f.many:
            one = replace(f, many=False)
            note(F.exists(raw, lambda x: x.isNotNull() & _value(x, have.elementType, one).isNull()), "type")
        elif f.kind == "dense_vector" and isinstance(have, T.ArrayType):
            note(F.exists(raw, lambda x: _unread(x, "float")), "type")
        elif f.kind == "geo_point" and isinstance(have, T.StructType):
            note(_unread(raw["lat"], "double") | _unread(raw["lon"], "double"), "type")
        else:
            note(raw.isNotNull() & _value(raw, have, f).isNull(), "type")
    if f.required:
        note(there & gone, "missing")
    if raw is None or not fits:
        return out
    if f.kind == "object":
        return out + _inner(f, path, raw, have)
    if f.kind == "nested":
        return out + [F.array_distinct(F.flatten(F.transform(
            raw, lambda x: _flat(_inner(f, path, x, have.elementType)))))]
    value = _value(raw, have, f)
    for what, test in f.rules():
        note(F.exists(value, lambda x: F.coalesce(~test(x), F.lit(False))) if f.many else ~test(value), what)
    return out


def _fits(f: Field, have: T.DataType) -> bool:
    """Whether the data's shape (object, list, single value) is the declared one."""
    if f.kind == "nested":
        return isinstance(have, T.ArrayType) and isinstance(have.elementType, T.StructType)
    if f.kind == "object":
        return isinstance(have, T.StructType)
    if f.many or f.kind == "dense_vector":
        return isinstance(have, T.ArrayType) and not isinstance(
            have.elementType, (T.StructType, T.ArrayType, T.MapType))
    if f.kind == "geo_point":
        return not isinstance(have, T.StructType) or {"lat", "lon"} <= set(have.names)
    return not isinstance(have, (T.StructType, T.ArrayType, T.MapType))


def _unread(raw: Column, kind: str) -> Column:
    return raw.isNotNull() & raw.try_cast(kind).isNull()


def _inner(f: Field, path: str, raw: Column, have: T.StructType) -> list[Column]:
    """The checks of an object's declared fields, and of fields it does not declare."""
    out, known = [], set()
    for sub in f.fields:
        name = sub.stored if sub.stored in have.names else sub.name if sub.name in have.names else None
        known.add(name)
        out += _checks(sub, f"{path}.{sub.name}", None if name is None else raw[name],
                       None if name is None else have[name].dataType, raw.isNotNull())
    for name in have.names:
        if name not in known:
            out.append(F.when(F.coalesce(raw[name].isNotNull(), F.lit(False)),
                              F.array(F.lit(f"{path}.{name}: unknown"))))
    return out


def validate(df: DataFrame, spec: Spec) -> DataFrame:
    """Adds ``_reasons``: every rule the row breaks, in declared order, also inside objects and lists
    (``a.b: what``); empty when valid. So a row without reasons loses no value when it is conformed."""
    return df.withColumn("_reasons", F.concat(
        F.array().cast("array<string>"), *[_reasons(df, f) for f in spec.fields]))


def split_valid(df: DataFrame, spec: Spec) -> tuple[DataFrame, DataFrame]:
    """(valid rows conformed, rejected rows as received with their reasons)."""
    checked = validate(df, spec)
    valid = conform(checked.where(F.size("_reasons") == 0).drop("_reasons"), spec)
    return valid, checked.where(F.size("_reasons") > 0)


def reject_reasons(checked: DataFrame) -> DataFrame:
    return checked.select(F.explode("_reasons").alias("reason")).groupBy("reason").agg(
        F.count(F.lit(1)).alias("n"))


def schema_report(df: DataFrame, spec: Spec) -> DataFrame:
    """Per declared field: rows, nulls, values that do not convert, values breaking a rule.
    One pass over the table whatever the number of fields."""
    cells, rows = [F.count(F.lit(1)).alias("rows")], []
    for i, f in enumerate(spec.fields):
        name, reasons = _source(df, f), _reasons(df, f)
        absent = F.lit(True) if name is None else F.col(name).isNull()
        uncast = F.exists(reasons, lambda r: r.endswith(": type"))
        outside = F.exists(reasons, lambda r: ~r.endswith(": type") & (r != f"{f.name}: missing"))
        for tag, test in (("n", absent), ("t", uncast), ("d", outside)):
            cells.append(F.count(F.when(test, F.lit(1))).alias(f"{tag}{i}"))
        rows.append(F.struct(
            F.lit(f.name).alias("field"), F.lit(f.kind).alias("kind"),
            F.lit(name is not None).alias("present"), F.col("rows").alias("n_rows"),
            F.col(f"n{i}").alias("n_null"), F.col(f"t{i}").alias("n_uncast"),
            F.col(f"d{i}").alias("n_outside"),
        ))
    return df.agg(*cells).select(F.inline(F.array(*rows)))


def evolve(old: DataFrame, new: DataFrame) -> tuple[DataFrame, list[tuple[str, str, str]]]:
    """Additive evolution: (old and new rows in one table, refused type changes).

    Types are merged field by field, also inside objects and lists of objects: fields that only one side has are null in
    the other's rows. A field whose type changed keeps its old type and is left empty in the new rows, with
    everything around it kept; it is reported as (path, old type, new type). Names are matched without regard to case;
    the old spelling stays.
    """
    refused: list[tuple[str, str, str]] = []
    merged = _merged(old.schema, new.schema, "", refused)

    def rows(df: DataFrame) -> DataFrame:
        at = {c.lower(): c for c in df.columns}
        return df.select(*[
            (F.lit(None).cast(want.dataType) if want.name.lower() not in at else _rebuilt(
                F.col(f"`{at[want.name.lower()]}`"), df.schema[at[want.name.lower()]].dataType, want.dataType)
             ).alias(want.name) for want in merged])

    return rows(old).unionByName(rows(new)), refused


def _merged(a: T.DataType, b: T.DataType, path: str, refused: list) -> T.DataType:
    """The old type with the new one's further fields; what cannot be merged stays and is noted."""
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        of = {f.name.lower(): f for f in b}
        out = T.StructType()
        for f in a:
            other = of.pop(f.name.lower(), None)
            kind = f.dataType if other is None else _merged(
                f.dataType, other.dataType, f"{path}.{f.name}".lstrip("."), refused)
            out.add(T.StructField(f.name, kind, True, f.metadata))
        for f in of.values():
            out.add(T.StructField(f.name, f.dataType, True, f.metadata))
        return out
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(_merged(a.elementType, b.elementType, path, refused))
    if a.simpleString() != b.simpleString():
        refused.append((path, a.simpleString(), b.simpleString()))
    return a


def _rebuilt(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """A value in the merged type: objects and elements are rebuilt field by field, what has another type is NULL."""
    if have.simpleString() == want.simpleString():
        return value
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        at = {f.name.lower(): f for f in have}
        return F.when(value.isNotNull(), F.struct(*[
            (F.lit(None).cast(f.dataType) if f.name.lower() not in at else _rebuilt(
                value[at[f.name.lower()].name], at[f.name.lower()].dataType, f.dataType)).alias(f.name)
            for f in want]))
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType) and (
            isinstance(have.elementType, (T.StructType, T.ArrayType)) and type(have.elementType)
            is type(want.elementType)):
        return F.transform(value, lambda x: _rebuilt(x, have.elementType, want.elementType))
    return F.lit(None).cast(want)


def with_subfields(df: DataFrame, spec: Spec) -> DataFrame:
    """The declared variants of each field as derived columns ``field__variant``."""
    made = {}
    for f in spec.fields:
        for variant, how in f.subfields.items():
            c = F.col(f.name)
            kind = how.get("type", "keyword")
            if kind == "text":
                value = tx.ANALYZERS[how.get("analyzer", "standard")](c)
            elif kind == "completion":
                value = tx.edge_ngrams(c, how.get("min", 1), how.get("max", 10))
            elif kind == "ngram":
                value = tx.ngrams(c, how.get("min", 2), how.get("max", 3))
            elif kind == "keyword":
                value = c.cast("string")
                if how.get("normalizer") == "lowercase":
                    value = tx.normalise(value)
                if "ignore_above" in how:
                    value = F.when(F.length(value) <= how["ignore_above"], value)
            else:
                value = c.cast(kind)
            made[f"{f.name}__{variant}"] = value
    return df.withColumns(made) if made else df

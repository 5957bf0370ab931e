"""Rows to stored JSON documents and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import from_micros
from ..spec import SYSTEM, Field, Spec


def _iso(v: Column, zone: str) -> Column:
    """ISO-8601; the fraction is written only when there is one."""
    whole = F.date_format(v, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(v, ".SSSSSS")
    return F.concat(whole, F.when(fraction != ".000000", fraction).otherwise(""), F.lit(zone))


def _encoded(f: Field, v: Column) -> Column:
    if f.kind == "object":
        inner = F.struct(*[_encoded(s, v[s.name]).alias(s.stored) for s in f.fields])
        return F.when(v.isNotNull(), inner)
    if f.kind == "nested":
        return F.transform(v, lambda x: F.struct(
            *[_encoded(s, x[s.name]).alias(s.stored) for s in f.fields]))
    if f.many:
        one = Field(f.name, f.kind)
        return F.transform(v, lambda x: _encoded(one, x))
    if f.kind == "datetime":
        return _iso(v, "Z")
    if f.kind == "time":
        return _iso(v, "")
    if f.kind == "date":
        return F.date_format(v, "yyyy-MM-dd")
    if f.kind == "binary":
        return F.base64(v)
    return v


def encode(df: DataFrame, spec: Spec, position: str | None = None) -> DataFrame:
    """(system columns, doc): the id field, excluded and computed fields are not stored. Documents
    without an id need a ``position`` (see ``Spec.with_id``)."""
    rows = spec.with_routing(spec.with_id(df, position))
    stored = [
        _encoded(f, F.col(f.name)).alias(f.stored)
        for f in spec.fields if f.name != spec.id_field and not f.exclude
    ]
    doc = F.to_json(F.struct(*stored), {"ignoreNullFields": "false"})
    return rows.select(*[c for c in rows.columns if c in SYSTEM], doc.alias("doc"))


def _json_type(f: Field) -> str:
    if f.kind in ("object", "nested"):
        inner = ",".join(f"`{s.stored}`:{_json_type(s)}" for s in f.fields)
        return f"struct<{inner}>" if f.kind == "object" else f"array<struct<{inner}>>"
    one = "string" if f.kind in ("datetime", "date", "time", "binary") else None
    if one is None:
        return f.type()
    return f"array<{one}>" if f.many else one


def _decoded(f: Field, v: Column) -> Column:
    if f.kind == "object":
        inner = F.struct(*[_decoded(s, v[s.stored]).alias(s.name) for s in f.fields])
        return F.when(v.isNotNull(), inner)
    if f.kind == "nested":
        return F.transform(v, lambda x: F.struct(
            *[_decoded(s, x[s.stored]).alias(s.name) for s in f.fields]))
    if f.many:
        one = Field(f.name, f.kind)
        return F.transform(v, lambda x: _decoded(one, x))
    if f.kind in ("datetime", "time"):
        # a written offset is converted to UTC, not dropped
        zoned = v.endswith("Z") | v.rlike("[+-][0-9]{2}:?[0-9]{2}$")
        return F.when(zoned, from_micros(F.unix_micros(v.try_cast("timestamp")))).otherwise(
            v.try_cast("timestamp_ntz"))
    if f.kind == "date":
        return v.try_cast("date")
    if f.kind == "binary":
        return F.unbase64(v)
    return v


def decode(stored: DataFrame, spec: Spec, source: Sequence[str] | None = None) -> DataFrame:
    """Typed rows with id and system columns. ``source`` names the fields to read; the
    others get their declared default."""
    wanted = [f for f in spec.fields if f.name != spec.id_field
              and (source is None or f.name in source)]
    shape = ",".join(f"`{f.stored}` {_json_type(f)}" for f in wanted)
    rows = stored.withColumn("_d", F.from_json("doc", shape)) if wanted else stored
    cols = []
    for f in spec.fields:
        if f.name == spec.id_field:
            cols.append(F.col("_id").cast(f.type()).alias(f.name))
        elif f in wanted:
            value = _decoded(f, F.col("_d")[f.stored])
            if not f.required and f.default is not None:
                value = F.coalesce(value, f.default_column())
            cols.append(value.alias(f.name))
        else:
            cols.append(f.default_column().alias(f.name))
    return rows.select(*[c for c in stored.columns if c in SYSTEM], *cols)


def select_fields(df: DataFrame, spec: Spec, source: Sequence[str]) -> DataFrame:
    """Columns named in ``source`` as they are, every other field at its default."""
    return df.select(*[c for c in df.columns if c in SYSTEM], *[
        F.col(f.name) if f.name in source or f.name == spec.id_field
        else f.default_column().alias(f.name)
        for f in spec.fields
    ])

"""Document specs: the declared fields of a table, their types, rules and identity."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field as dc_field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# System columns a stored row may carry beside its fields.
SYSTEM = ("_id", "_routing", "_version", "_seq_no", "_primary_term", "_score", "_deleted")

# Field kinds and the column types they are stored as.
KINDS = {
    "keyword": "string", "text": "string", "binary": "binary",
    "byte": "tinyint", "short": "smallint", "integer": "int", "long": "bigint",
    "unsigned_long": "decimal(20,0)", "half_float": "float", "float": "float",
    "double": "double", "boolean": "boolean",
    "datetime": "timestamp_ntz", "date": "date", "time": "timestamp_ntz",
    "uuid": "string", "url": "string", "http_url": "string", "path": "string", "ip": "string",
    "geo_point": "struct<lat:double,lon:double>", "dense_vector": "array<float>",
}
STRINGS = {"keyword", "text", "uuid", "url", "http_url", "path", "ip"}

# Shapes of checked strings.
OCTET = r"(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
IPV4 = rf"^({OCTET}\.){{3}}{OCTET}$"
IPV6_FULL = r"^([0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}$"
IPV6_SHORT = r"^(([0-9A-Fa-f]{1,4}:)*[0-9A-Fa-f]{1,4})?::(([0-9A-Fa-f]{1,4}:)*[0-9A-Fa-f]{1,4})?$"
PATTERNS = {
    "uuid": r"^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$",
    "url": r"^[A-Za-z][A-Za-z0-9+.-]*://[^\s/?#]+[^\s]*$",
    "http_url": r"^https?://[^\s/?#]+[^\s]*$",
}

REQUIRED = object()


def is_ip(v: Column) -> Column:
    groups = F.size(F.filter(F.split(v, ":"), lambda g: g != ""))
    return v.rlike(IPV4) | v.rlike(IPV6_FULL) | (v.rlike(IPV6_SHORT) & (groups <= 7))


@dataclass(frozen=True)
class Field:
    name: str
    kind: str = "keyword"  # a key of KINDS, "object" or "nested"
    default: object = REQUIRED  # REQUIRED, None for optional, or a value
    alias: str | None = None
    many: bool = False  # a list of primitives
    fields: tuple["Field", ...] = ()  # of an object or nested list
    subfields: dict[str, dict] = dc_field(default_factory=dict)
    index: bool = True
    exclude: bool = False
    gt: float | None = None
    ge: float | None = None
    lt: float | None = None
    le: float | None = None
    multiple_of: float | None = None
    allow_inf_nan: bool = True
    min_length: int | None = None
    max_length: int | None = None
    pattern: str | None = None
    allowed: Sequence | None = None
    dims: int | None = None
    similarity: str = "cosine"

    @property
    def stored(self) -> str:
        return self.alias or self.name

    @property
    def required(self) -> bool:
        return self.default is REQUIRED

    def type(self) -> str:
        if self.kind in ("object", "nested"):
            inner = ",".join(f"`{f.name}`:{f.type()}" for f in self.fields)
            return f"struct<{inner}>" if self.kind == "object" else f"array<struct<{inner}>>"
        return f"array<{KINDS[self.kind]}>" if self.many else KINDS[self.kind]

    def default_column(self) -> Column:
        value = None if self.required else self.default
        return F.lit(value).cast(self.type())

    def rules(self) -> list[tuple[str, Callable[[Column], Column]]]:
        """(reason, test that a present value must pass), declared order."""
        out: list[tuple[str, Callable[[Column], Column]]] = []

        def add(reason, test):
            out.append((reason, test))

        if self.kind == "unsigned_long":
            add("negative", lambda v: v >= 0)
        if self.gt is not None:
            add(f"not > {self.gt}", lambda v: v > self.gt)
        if self.ge is not None:
            add(f"not >= {self.ge}", lambda v: v >= self.ge)
        if self.lt is not None:
            add(f"not < {self.lt}", lambda v: v < self.lt)
        if self.le is not None:
            add(f"not <= {self.le}", lambda v: v <= self.le)
        if self.multiple_of is not None:
            add(f"not a multiple of {self.multiple_of}", lambda v: v % self.multiple_of == 0)
        if not self.allow_inf_nan:
            add("not finite", lambda v: ~F.isnan(v) & (F.abs(v) != float("inf")))
        if self.min_length is not None:
            add(f"shorter than {self.min_length}", lambda v: F.length(v) >= self.min_length)
        if self.max_length is not None:
            add(f"longer than {self.max_length}", lambda v: F.length(v) <= self.max_length)
        if self.pattern is not None:
            add("pattern", lambda v: v.rlike(self.pattern))
        if self.kind in PATTERNS:
            add(f"not a {self.kind}", lambda v: v.rlike(PATTERNS[self.kind]))
        if self.kind == "ip":
            add("not an ip", is_ip)
        if self.kind == "geo_point":
            add("out of range", lambda v: v["lat"].between(-90, 90) & v["lon"].between(-180, 180))
        if self.allowed is not None:
            add("not allowed", lambda v: v.isin(list(self.allowed)))
        if self.dims is not None:
            add(f"not {self.dims} dims", lambda v: F.size(v) == self.dims)
        return out


@dataclass(frozen=True)
class Spec:
    name: str
    fields: tuple[Field, ...]
    id_field: str | None = None
    id_expr: Callable[[], Column] | None = None
    routing_expr: Callable[[], Column] | None = None
    default_sort: object = None
    computed: dict[str, Callable[[], Column]] = dc_field(default_factory=dict)

    def field(self, name: str) -> Field:
        return next(f for f in self.fields if f.name == name)

    def sort_or(self, explicit):
        """The sort that counts: the caller's, else the declared one."""
        return explicit if explicit is not None else self.default_sort

    def schema(self) -> T.StructType:
        """The table's type, with each field's declaration kept as column metadata."""
        out = T.StructType()
        for f in self.fields:
            meta = {"kind": f.kind, "index": f.index}
            if f.alias:
                meta["alias"] = f.alias
            if f.dims:
                meta.update(dims=f.dims, similarity=f.similarity)
            if f.subfields:
                meta["subfields"] = sorted(f.subfields)
            out.add(f.name, T.DataType.fromDDL(f.type()), not f.required, meta)
        return out

    def with_id(self, df, position: str | None = None):
        """``_id``: the id field, else the computed id, else 20 characters made of the row's content
        and ``position``, a column that tells equal rows apart and is the same on every run (a
        place in the source, an operation number). So equal documents keep ids of their own, and
        a retried task makes the same ones. Without a position there is nothing to make ids of."""
        if self.id_field:
            made = F.col(self.id_field).cast("string")
        elif self.id_expr:
            made = self.id_expr().cast("string")
        else:
            made = F.lit(None).cast("string")
        if "_id" in df.columns:
            made = F.coalesce(F.col("_id"), made)
        if position is None:
            if self.id_field or self.id_expr or "_id" in df.columns:
                return df.withColumn("_id", made)
            raise ValueError(f"{self.name} has no id; name a column that tells its rows apart")
        present = [f.name for f in self.fields if f.name in df.columns]
        content = F.to_json(F.struct(*dict.fromkeys([*present, position])))
        return df.withColumn("_id", F.coalesce(made, F.substring(F.sha2(content, 256), 1, 20)))

    def with_routing(self, df):
        if self.routing_expr is None:
            return df
        made = self.routing_expr().cast("string")
        if "_routing" in df.columns:
            made = F.coalesce(F.col("_routing"), made)
        return df.withColumn("_routing", made)

    def with_computed(self, df):
        return df.withColumns({n: e() for n, e in self.computed.items()})

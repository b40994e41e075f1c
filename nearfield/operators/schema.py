"""Declared schemas over tables: projection and casts, validation, profiling, kind inference."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Scalar type names of a declared schema and the Spark type each stands for.
SCALARS = {
    "Int64": T.LongType(),
    "Int32": T.IntegerType(),
    "Int16": T.ShortType(),
    "Int8": T.ByteType(),
    "Bool": T.BooleanType(),
    "Float": T.FloatType(),
    "Double": T.DoubleType(),
    "String": T.StringType(),
    "VarChar": T.StringType(),
    "JSON": T.StringType(),
}
# Vector type names.
VECTORS = {
    "FloatVector": T.ArrayType(T.FloatType()),
    "BinaryVector": T.BinaryType(),
    "Float16Vector": T.BinaryType(),
    "BFloat16Vector": T.BinaryType(),
    "SparseFloatVector": T.MapType(T.LongType(), T.FloatType()),
}
# Element types an array may have, and types a struct element's field may have.
ELEMENTS = ("Bool", "Int8", "Int16", "Int32", "Int64", "Float", "Double", "VarChar")
STRUCT_FIELDS = ("Int64", "Int32", "Float", "Double", "VarChar", "Bool", "FloatVector")
BYTES_PER_DIM = {"BinaryVector": 1 / 8, "Float16Vector": 2, "BFloat16Vector": 2}


@dataclass(frozen=True)
class FieldSpec:
    name: str
    data_type: str
    primary_key: bool = False
    auto_id: bool = False
    dimension: int = 0
    max_length: int = 0
    element_type: str = ""
    max_capacity: int = 0
    nullable: bool | None = None
    enable_analyzer: bool = False
    enable_match: bool = False
    analyzer_params: Mapping | None = None
    description: str = ""
    struct_fields: tuple["FieldSpec", ...] = ()

    @classmethod
    def from_dict(cls, d: Mapping) -> "FieldSpec":
        return cls(
            name=d["name"], data_type=d.get("dataType", ""), primary_key=d.get("isPrimaryKey", False),
            auto_id=d.get("isAutoID", False), dimension=d.get("dimension", 0), max_length=d.get("maxLength", 0),
            element_type=d.get("elementType", ""), max_capacity=d.get("maxCapacity", 0), nullable=d.get("nullable"),
            enable_analyzer=d.get("enableAnalyzer", False), enable_match=d.get("enableMatch", False),
            analyzer_params=d.get("analyzerParams"), description=d.get("description", ""),
            struct_fields=tuple(cls.from_dict(s) for s in d.get("structFields", ())))

    def spark_type(self) -> T.DataType:
        if not self.data_type:
            raise ValueError(f"field {self.name} has no data type")
        if self.data_type in SCALARS:
            return SCALARS[self.data_type]
        if self.data_type in VECTORS:
            return VECTORS[self.data_type]
        if self.data_type != "Array":
            raise ValueError(f"field {self.name} has unsupported data type {self.data_type}")
        if self.element_type in ELEMENTS:
            return T.ArrayType(SCALARS[self.element_type])
        if self.element_type != "Struct":
            raise ValueError(f"field {self.name} has unsupported element type {self.element_type or 'none'}")
        if not self.struct_fields:
            raise ValueError(f"field {self.name} declares no struct fields")
        for sub in self.struct_fields:
            if sub.data_type not in STRUCT_FIELDS:
                raise ValueError(f"field {self.name}.{sub.name} has unsupported data type {sub.data_type or 'none'}")
        return T.ArrayType(T.StructType([T.StructField(s.name, s.spark_type()) for s in self.struct_fields]))

    def struct_field(self) -> T.StructField:
        limits = {"maxLength": self.max_length, "dimension": self.dimension, "maxCapacity": self.max_capacity,
                  "isPrimaryKey": self.primary_key, "isAutoID": self.auto_id, "enableMatch": self.enable_match,
                  "enableAnalyzer": self.enable_analyzer, "analyzerParams": dict(self.analyzer_params or {})}
        return T.StructField(self.name, self.spark_type(), bool(self.nullable), {k: v for k, v in limits.items() if v})


# The kinds of functions a schema may declare.
FUNCTION_TYPES = ("BM25", "TextEmbedding")


@dataclass(frozen=True)
class FunctionSpec:
    name: str
    function_type: str
    inputs: tuple[str, ...]
    outputs: tuple[str, ...]
    params: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self):
        if self.function_type not in FUNCTION_TYPES:
            raise ValueError(f"unsupported function type: {self.function_type}")
        if len(self.inputs) != 1 or len(self.outputs) != 1:
            raise ValueError(f"function {self.name} needs one input and one output field")


@dataclass(frozen=True)
class CollectionSpec:
    name: str
    fields: tuple[FieldSpec, ...]
    description: str = ""
    functions: tuple[FunctionSpec, ...] = ()
    num_shards: int = 0

    @classmethod
    def from_dict(cls, d: Mapping) -> "CollectionSpec":
        functions = tuple(
            FunctionSpec(f["name"], f.get("functionType", ""), tuple(f.get("inputFieldNames", ())),
                         tuple(f.get("outputFieldNames", ())), f.get("params", {})) for f in d.get("functions", ()))
        spec = cls(d["name"], tuple(FieldSpec.from_dict(f) for f in d["fields"]), d.get("description", ""), functions,
                   d.get("numShards", 0))
        spec.schema()
        return spec

    @classmethod
    def from_json(cls, text: str) -> "CollectionSpec":
        return cls.from_dict(json.loads(text))

    def schema(self) -> T.StructType:
        if not self.fields:
            raise ValueError("a collection needs at least one field")
        return T.StructType([f.struct_field() for f in self.fields])

    @property
    def primary_key(self) -> str | None:
        return next((f.name for f in self.fields if f.primary_key), None)


# ---------------------------------------------------------------- casts


def convert(c: Column, source: T.DataType, target: T.DataType) -> Column:
    """Typed value of a nested column; scalars that do not fit become null."""
    if isinstance(target, T.ArrayType):
        if isinstance(source, T.VariantType):
            return F.transform(F.try_variant_get(c, "$", "array<variant>"),
                               lambda x: convert(x, T.VariantType(), target.elementType))
        if not isinstance(source, T.ArrayType):
            return F.lit(None).cast(target)
        return F.transform(c, lambda x: convert(x, source.elementType, target.elementType))
    if isinstance(target, T.StructType):
        if isinstance(source, T.VariantType):
            parts = [convert(F.try_variant_get(c, f"$['{f.name}']", "variant"), source, f.dataType).alias(f.name) for f in target]
        elif isinstance(source, T.StructType):
            known = {f.name: f.dataType for f in source}
            parts = [(convert(c.getField(f.name), known[f.name], f.dataType) if f.name in known
                      else F.lit(None).cast(f.dataType)).alias(f.name) for f in target]
        else:
            return F.lit(None).cast(target)
        return F.when(c.isNotNull(), F.struct(*parts))
    if isinstance(source, T.VariantType):
        return F.try_variant_get(c, "$", target.simpleString())
    if isinstance(source, (T.ArrayType, T.StructType, T.MapType)) and isinstance(target, T.StringType):
        return F.to_json(c)
    if source == target or isinstance(source, T.NullType):
        return c.cast(target)
    return c.try_cast(target)


def cast_to_spec(df: DataFrame, spec: CollectionSpec) -> DataFrame:
    """Convert the declared columns, nested ones included; other columns are dropped."""
    have = {f.name: f.dataType for f in df.schema.fields}
    made = {name for fn in spec.functions for name in fn.outputs}
    missing = [f.name for f in spec.fields if f.name not in have and not f.auto_id and f.name not in made]
    if missing:
        raise ValueError(f"missing fields {missing}")
    fields = [f.struct_field() for f in spec.fields if f.name in have]
    return df.select(*[convert(F.col(f"`{f.name}`"), have[f.name], f.dataType).alias(f.name, metadata=f.metadata)
                       for f in fields])


def conform(df: DataFrame, spec: CollectionSpec | Mapping | str) -> DataFrame:
    """Project and cast a table to a declared schema.

    Generated keys and the outputs of declared functions are added when absent. A BM25 function gives a map from term id
    to weight over the table's own statistics (its rows need the primary key), TextEmbedding a hashed
    vector of the output field's dimension.
    """
    if isinstance(spec, str):
        spec = CollectionSpec.from_json(spec)
    elif not isinstance(spec, CollectionSpec):
        spec = CollectionSpec.from_dict(spec)
    out = cast_to_spec(df, spec)
    for f in spec.fields:
        if f.auto_id and f.name not in out.columns:
            out = with_auto_id(out, f.name)
    for fn in spec.functions:
        if fn.outputs[0] not in out.columns:
            out = apply_function(out, fn, spec)
    return out.select(*[f.name for f in spec.fields])


def apply_function(df: DataFrame, fn: FunctionSpec, spec: CollectionSpec) -> DataFrame:
    """Add the output field of a declared function."""
    from nearfield.operators import fulltext

    source, into = fn.inputs[0], fn.outputs[0]
    if fn.function_type == "BM25":
        if spec.primary_key is None:
            raise ValueError("a BM25 function needs a primary key")
        return fulltext.bm25_encode(df, id=spec.primary_key, text=source, into=into)
    dim = next((f.dimension for f in spec.fields if f.name == into and f.dimension), None) or int(fn.params.get("dim", 64))
    return fulltext.text_embedding(df, source, into, dim).drop("__h")


def with_auto_id(df: DataFrame, name: str = "id", dense: bool = False) -> DataFrame:
    """Add a generated key: unique, or gap-free from 0 with ``dense``."""
    if dense:
        from nearfield.operators.tables import number_rows

        return number_rows(df, into=name)
    return df.withColumn(name, F.monotonically_increasing_id())


def flatten_struct(df: DataFrame, sep: str = "_") -> DataFrame:
    """Nested struct columns as flat columns named by path."""
    def leaves(schema: T.StructType, path: tuple[str, ...]):
        for f in schema:
            if isinstance(f.dataType, T.StructType):
                yield from leaves(f.dataType, (*path, f.name))
            else:
                yield (*path, f.name)

    return df.select(*[F.col(".".join(f"`{p}`" for p in path)).alias(sep.join(path)) for path in leaves(df.schema, ())])


# ---------------------------------------------------------------- validation


def _longer_or_shorter(size: int):
    return lambda x: F.size(x) != size


def _beyond(size: int):
    return lambda x: F.octet_length(x) > size


def _rules(spec: CollectionSpec) -> list[tuple[str, str, Column]]:
    rules = []
    for f in spec.fields:
        c = F.col(f"`{f.name}`")
        if not f.nullable and not f.auto_id:
            rules.append((f.name, "null", c.isNull()))
        if f.max_length and f.data_type in ("VarChar", "String"):
            rules.append((f.name, "max_length", F.octet_length(c) > f.max_length))
        if f.max_length and f.element_type == "VarChar":
            rules.append((f.name, "max_length", F.exists(c, _beyond(f.max_length))))
        if f.data_type == "FloatVector":
            if f.dimension:
                rules.append((f.name, "dimension", F.size(c) != f.dimension))
            rules.append((f.name, "not_finite", F.exists(c, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))))
        if f.data_type in BYTES_PER_DIM and f.dimension:
            rules.append((f.name, "dimension", F.octet_length(c) != int(f.dimension * BYTES_PER_DIM[f.data_type])))
        if f.max_capacity and f.data_type == "Array":
            rules.append((f.name, "max_capacity", F.size(c) > f.max_capacity))
        for sub in f.struct_fields:
            part = c.getField(sub.name)
            if sub.dimension:
                rules.append((f"{f.name}.{sub.name}", "dimension", F.exists(part, _longer_or_shorter(sub.dimension))))
            if sub.max_length:
                rules.append((f"{f.name}.{sub.name}", "max_length", F.exists(part, _beyond(sub.max_length))))
    return [(name, rule, F.coalesce(bad, F.lit(False))) for name, rule, bad in rules]


def validate(df: DataFrame, spec: CollectionSpec) -> DataFrame:
    """``(field, rule, violations)`` from one aggregation, plus rows that repeat a primary key."""
    rules = _rules(spec)
    row = df.agg(*[F.count_if(bad).alias(f"r{i}") for i, (_, _, bad) in enumerate(rules)])
    counts = row.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("field"), F.lit(rule).alias("rule"), F.col(f"r{i}").alias("violations"))
        for i, (name, rule, _) in enumerate(rules)])))
    pk = spec.primary_key
    if pk is None:
        return counts
    repeats = df.groupBy(pk).agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("violations"))
    return counts.unionByName(repeats.select(F.lit(pk).alias("field"), F.lit("duplicate_key").alias("rule"), "violations"))


def bad_rows(df: DataFrame, spec: CollectionSpec) -> DataFrame:
    """Rows that break a per-row rule, with the rules broken."""
    broken = F.filter(F.array(*[F.when(bad, F.lit(f"{name}:{rule}")) for name, rule, bad in _rules(spec)]), lambda x: x.isNotNull())
    return df.withColumn("broken", broken).filter(F.size("broken") > 0)


def profile(df: DataFrame, spec: CollectionSpec) -> DataFrame:
    """Row count, and per field nulls, value size range and approximate distinct keys."""
    sized = {}
    for f in spec.fields:
        c = F.col(f"`{f.name}`")
        if f.data_type in ("FloatVector", "Array", "SparseFloatVector"):
            sized[f.name] = F.when(c.isNotNull(), F.size(c))
        elif f.data_type in ("VarChar", "String", "JSON"):
            sized[f.name] = F.length(c)
        else:
            sized[f.name] = F.lit(None).cast("int")
    aggregates = [F.count(F.lit(1)).alias("n_rows")]
    for i, f in enumerate(spec.fields):
        aggregates += [F.count_if(F.col(f"`{f.name}`").isNull()).alias(f"n{i}"), F.min(sized[f.name]).alias(f"lo{i}"),
                       F.max(sized[f.name]).alias(f"hi{i}"),
                       (F.approx_count_distinct(F.col(f"`{f.name}`"), 0.01) if f.primary_key else F.lit(None).cast("bigint")).alias(f"d{i}")]
    row = df.agg(*aggregates)
    return row.select("n_rows", F.inline(F.array(*[
        F.struct(F.lit(f.name).alias("field"), F.col(f"n{i}").alias("nulls"), F.col(f"lo{i}").alias("min_size"),
                 F.col(f"hi{i}").alias("max_size"), F.col(f"d{i}").alias("approx_distinct")) for i, f in enumerate(spec.fields)])))


# ---------------------------------------------------------------- inference


def infer_column_kinds(raw: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``(field, kind)`` of untyped values, decided from every row of the table.

    ``raw`` holds JSON text per column (or a ``variant``). Rules: whole numbers are Int64 only in a
    field named ``id``, other numbers Float; equally long numeric lists of more than one element, or
    with a fraction, are a vector, other numeric lists Array<Int64> or Array<Float>; objects whose
    keys all start with a digit are sparse vectors, other objects JSON; rows that disagree are JSON.
    """
    columns = columns or raw.columns

    def variant(name: str) -> Column:
        c = F.col(f"`{name}`")
        return c if isinstance(raw.schema[name].dataType, T.VariantType) else F.try_parse_json(c)

    # one row per value, so that a single set of aggregates serves all columns
    values = raw.select(F.inline(F.array(*[F.struct(F.lit(c).alias("field"), variant(c).alias("v")) for c in columns])))
    v = F.col("v")
    values = values.select("field", "v", F.schema_of_variant(v).alias("type"), F.try_variant_get(v, "$", "double").alias("number"),
                           F.try_variant_get(v, "$", "array<variant>").alias("items"),
                           F.map_keys(F.try_variant_get(v, "$", "map<string,variant>")).alias("keys"))
    values = values.select("*", F.transform("items", lambda x: F.try_variant_get(x, "$", "double")).alias("doubles"),
                           F.transform("items", F.schema_of_variant).alias("types"))
    kind, types, doubles = F.col("type"), F.col("types"), F.col("doubles")
    shape = (F.when(v.isNull() | (kind == "VOID"), F.lit(None).cast("string"))
             .when(kind == "BOOLEAN", "bool").when(kind == "STRING", "text")
             .when(kind.startswith("ARRAY"), "list").when(kind.startswith("OBJECT"), "object").otherwise("number"))
    numeric = F.forall(doubles, lambda x: x.isNotNull()) & ~F.exists(types, lambda t: t.isin("STRING", "BOOLEAN"))
    facts = values.groupBy("field").agg(
        F.collect_set(shape).alias("shapes"), F.bool_and(F.col("number") == F.floor("number")).alias("whole"),
        F.min(F.size("items")).alias("lo"), F.max(F.size("items")).alias("hi"), F.bool_and(numeric).alias("nums"),
        F.bool_and(F.forall(types, lambda t: t == "STRING")).alias("strs"),
        F.bool_and(F.forall(types, lambda t: t == "BOOLEAN")).alias("bools"),
        F.bool_and(F.forall(types, lambda t: t.startswith("OBJECT"))).alias("objs"),
        F.bool_and(F.forall(doubles, lambda x: x == F.floor(x))).alias("ints"),
        F.bool_and((F.size("keys") > 0) & F.forall("keys", lambda key: key.rlike("^[0-9]"))).alias("sparse"))
    c = F.col
    shape = F.when(F.size("shapes") == 1, F.get("shapes", F.lit(0)))
    vector = c("nums") & (c("lo") == c("hi")) & ((c("hi") > 1) | ~c("ints"))
    listed = (F.when(c("hi") == 0, "JSON").when(vector, "FloatVector").when(c("nums") & c("ints"), "Array<Int64>")
              .when(c("nums"), "Array<Float>").when(c("strs"), "Array<VarChar>").when(c("bools"), "Array<Bool>")
              .when(c("objs"), "Array<Struct>").otherwise("JSON"))
    decided = (F.when(shape == "bool", "Bool").when(shape == "text", "VarChar")
               .when(shape == "number", F.when((c("field") == "id") & c("whole"), "Int64").otherwise("Float"))
               .when(shape == "list", listed).when(shape == "object", F.when(c("sparse"), "SparseFloatVector").otherwise("JSON"))
               .otherwise(F.when(F.size("shapes") == 0, F.lit(None)).otherwise("JSON")))
    return facts.select("field", decided.alias("kind"))

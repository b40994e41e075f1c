"""Vector codecs and distances as Column expressions. Inputs are widened to double first."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _double(c: Column | str) -> Column:
    return _col(c).cast("array<double>")


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def _same_length(a: Column, b: Column, value: Column) -> Column:
    return F.when(F.size(a) == F.size(b), value).when(
        F.size(a) != F.size(b), F.raise_error(F.lit("vectors must have the same length")).cast("double"))


def l2(a: Column | str, b: Column | str) -> Column:
    """Euclidean distance."""
    a, b = _double(a), _double(b)
    return _same_length(a, b, F.sqrt(_total(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)))))


def inner_product(a: Column | str, b: Column | str) -> Column:
    a, b = _double(a), _double(b)
    return _same_length(a, b, _total(F.zip_with(a, b, lambda x, y: x * y)))


def norm(v: Column | str) -> Column:
    return F.sqrt(_total(F.transform(_double(v), lambda x: x * x)))


def normalize(v: Column | str) -> Column:
    """Scale to length one; a zero vector stays zero."""
    n = norm(v)
    return F.when(n == 0, _double(v)).otherwise(F.transform(_double(v), lambda x: x / n))


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine similarity; 0 when either vector is zero."""
    scale = norm(a) * norm(b)
    return F.when(scale == 0, F.lit(0.0)).otherwise(inner_product(a, b) / scale)


def cosine_distance(a: Column | str, b: Column | str) -> Column:
    """``1 - cosine``; 1 when either vector is zero."""
    return F.lit(1.0) - cosine(a, b)


def cost_column(a: Column | str, b: Column | str, metric: str) -> Column:
    """Lower-is-better form of a dense metric."""
    if metric == "l2":
        return l2(a, b)
    return -(inner_product(a, b) if metric == "ip" else cosine(a, b))


def sparse_inner_product(a: Column | str, b: Column | str) -> Column:
    """Sum of products over the positions two sparse vectors share."""
    a, b = _col(a), _col(b)
    return _total(F.transform(F.array_intersect(F.map_keys(a), F.map_keys(b)),
                              lambda p: F.element_at(a, p).cast("double") * F.element_at(b, p).cast("double")))


def sparse_norm(v: Column | str) -> Column:
    return norm(F.map_values(_col(v)))


def parse_sparse(df: DataFrame, column: str, into: str = "sparse") -> DataFrame:
    """JSON objects with string positions to ``map<bigint,double>``; other keys are left out."""
    raw = F.from_json(F.col(column), "map<string,double>")
    kept = F.map_filter(raw, lambda key, value: key.rlike("^[0-9]+$") & value.isNotNull())
    return df.withColumn(into, F.transform_keys(kept, lambda key, value: key.cast("bigint")))


def drop_small(v: Column | str, ratio: float) -> Column:
    """Remove the share ``ratio`` of entries with the smallest magnitude from a sparse vector."""
    v = _col(v)
    sizes = F.array_sort(F.transform(F.map_values(v), lambda x: F.abs(x.cast("double"))))
    cut = F.floor(F.size(sizes) * F.lit(float(ratio))).cast("int")
    floor = F.get(sizes, cut)
    return F.map_filter(v, lambda key, value: F.abs(value.cast("double")) >= floor)


def binarize_vectors(df: DataFrame, column: str, into: str = "bits") -> DataFrame:
    """Sign bits of float vectors, eight per byte; the dimension must be a multiple of eight. Null stays null."""

    @F.pandas_udf("binary")
    def pack(vectors: pd.Series) -> pd.Series:
        out = pd.Series([None] * len(vectors), dtype=object)
        there = np.flatnonzero(vectors.notna())
        if len(there):
            m = np.stack(vectors.iloc[there].to_numpy())
            if m.shape[1] % 8:
                raise ValueError("the dimension must be a multiple of 8")
            packed, width = np.packbits(m > 0, axis=1).tobytes(), m.shape[1] // 8
            for n, i in enumerate(there.tolist()):
                out.iat[i] = packed[n * width : (n + 1) * width]
        return out

    return df.withColumn(into, pack(F.col(column)))


def unpack_bits(df: DataFrame, column: str, into: str) -> DataFrame:
    """Packed binary vectors as 0/1 float vectors; null stays null."""

    @F.pandas_udf("array<float>")
    def unpack(vectors: pd.Series) -> pd.Series:
        return pd.Series([None if v is None else np.unpackbits(np.frombuffer(v, np.uint8)).astype(np.float32) for v in vectors],
                         dtype=object)

    return df.withColumn(into, unpack(F.col(column)))


def decode_vectors(df: DataFrame, column: str, kind: str, into: str = "vector") -> DataFrame:
    """Half-precision vectors at rest (``f16`` or ``bf16`` bytes, little endian) as ``array<float>``."""
    if kind not in ("f16", "bf16"):
        raise ValueError("kind must be f16 or bf16")
    schema = T.StructType([*df.schema.fields, T.StructField(into, T.ArrayType(T.FloatType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(column).to_pylist()
            flat = np.frombuffer(b"".join(r or b"" for r in raw), "<u2")
            if kind == "f16":
                values = flat.view(np.float16).astype(np.float32)
            else:
                values = (flat.astype(np.uint32) << 16).view(np.float32)
            ends = np.concatenate([[0], np.cumsum([len(r or b"") // 2 for r in raw])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(values, pa.float32()),
                                             mask=pa.array([r is None for r in raw]))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=schema.names)

    return df.mapInArrow(run, schema)

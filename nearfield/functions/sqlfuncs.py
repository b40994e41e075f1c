"""Vector and text functions for SQL text: temporary SQL functions, inlined by Catalyst."""

from __future__ import annotations

from pyspark.sql import SparkSession

SUM = "aggregate({}, CAST(0 AS DOUBLE), (acc, x) -> acc + x)"
_IP = SUM.format("zip_with(a, b, (x, y) -> CAST(x AS DOUBLE) * CAST(y AS DOUBLE))")
_SQ = "zip_with({0}, {0}, (x, y) -> CAST(x AS DOUBLE) * CAST(y AS DOUBLE))"
_L2 = SUM.format("zip_with(a, b, (x, y) -> (CAST(x AS DOUBLE) - CAST(y AS DOUBLE)) * (CAST(x AS DOUBLE) - CAST(y AS DOUBLE)))")
_NORMS = f"sqrt({SUM.format(_SQ.format('a'))}) * sqrt({SUM.format(_SQ.format('b'))})"

DEFINITIONS = {
    "vec_l2": ("a ARRAY<DOUBLE>, b ARRAY<DOUBLE>", "DOUBLE", f"sqrt({_L2})"),
    "vec_ip": ("a ARRAY<DOUBLE>, b ARRAY<DOUBLE>", "DOUBLE", _IP),
    "vec_cosine": ("a ARRAY<DOUBLE>, b ARRAY<DOUBLE>", "DOUBLE",
                   f"CASE WHEN {_NORMS} = 0 THEN CAST(0 AS DOUBLE) ELSE {_IP} / ({_NORMS}) END"),
    "vec_norm": ("a ARRAY<DOUBLE>", "DOUBLE", f"sqrt({SUM.format(_SQ.format('a'))})"),
    "sparse_ip": ("a MAP<BIGINT, DOUBLE>, b MAP<BIGINT, DOUBLE>", "DOUBLE",
                  SUM.format("transform(array_intersect(map_keys(a), map_keys(b)), p -> a[p] * b[p])")),
    "tokens": ("t STRING", "ARRAY<STRING>", r"filter(split(lower(t), '[^\\p{L}\\p{N}]+'), w -> w <> '')"),
}


def register_functions(spark: SparkSession) -> list[str]:
    """Create the functions in the session and return their names."""
    for name, (arguments, result, body) in DEFINITIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {result} RETURN {body}")
    return list(DEFINITIONS)

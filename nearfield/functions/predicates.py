"""Filter conditions as Column builders, for scalars, JSON, arrays, struct arrays and text.

Where an element-level result is meant (one row per matching element) the builder is
:func:`element_rows`; the ``match_*`` family decides whole rows. Row conditions on arrays never
return null, so negating them is safe.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearfield.functions.text import tokenize

Predicate = Callable[[Column], Column]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def between(c: Column | str, low=None, high=None, low_open: bool = False, high_open: bool = True) -> Column:
    """Range condition, half-open ``[low, high)`` by default."""
    c = _col(c)
    parts = []
    if low is not None:
        parts.append(c > low if low_open else c >= low)
    if high is not None:
        parts.append(c < high if high_open else c <= high)
    if not parts:
        return c.isNotNull()
    return parts[0] & parts[1] if len(parts) == 2 else parts[0]


def one_of(c: Column | str, values: Sequence) -> Column:
    return _col(c).isin(list(values))


def like(c: Column | str, pattern: str) -> Column:
    """SQL LIKE; a pure prefix pattern becomes ``startswith``, which Parquet can skip on."""
    body = pattern[:-1]
    if pattern.endswith("%") and not any(ch in body for ch in "%_\\"):
        return _col(c).startswith(body)
    return _col(c).like(pattern)


def json_field(c: Column | str, path: str, type: str = "string") -> Column:
    """Typed value at a JSON path; null when absent, unparsable or of another type."""
    return F.try_variant_get(F.try_parse_json(_col(c)), path, type)


def subfield(array: Column | str, name: str) -> Column:
    """One field of every element of a struct array."""
    return _col(array).getField(name)


def element(array: Column | str, index: int, name: str | None = None) -> Column:
    """0-based element (or its field); null when out of range."""
    item = F.get(_col(array), F.lit(index))
    return item.getField(name) if name else item


def contains(array: Column | str, value) -> Column:
    return F.coalesce(F.array_contains(_col(array), value), F.lit(False))


def contains_any(array: Column | str, values: Sequence) -> Column:
    return F.coalesce(F.arrays_overlap(_col(array), F.array(*[F.lit(v) for v in values])), F.lit(False))


def contains_all(array: Column | str, values: Sequence) -> Column:
    wanted = F.array(*[F.lit(v) for v in values])
    return F.coalesce(F.size(F.array_except(wanted, _col(array))) == 0, F.lit(False))


def length(array: Column | str) -> Column:
    """Number of elements; 0 for null."""
    return F.when(_col(array).isNull(), 0).otherwise(F.size(_col(array)))


def matches(array: Column | str, predicate: Predicate) -> Column:
    """How many elements satisfy the predicate."""
    return length(F.filter(_col(array), predicate))


def match_any(array: Column | str, predicate: Predicate) -> Column:
    return F.coalesce(F.exists(_col(array), lambda e: F.coalesce(predicate(e), F.lit(False))), F.lit(False))


def match_all(array: Column | str, predicate: Predicate) -> Column:
    return F.coalesce(F.forall(_col(array), lambda e: F.coalesce(predicate(e), F.lit(False))), F.lit(False))


def match_least(array: Column | str, predicate: Predicate, threshold: int) -> Column:
    return matches(array, predicate) >= threshold


def match_most(array: Column | str, predicate: Predicate, threshold: int) -> Column:
    return matches(array, predicate) <= threshold


def match_exact(array: Column | str, predicate: Predicate, threshold: int) -> Column:
    return matches(array, predicate) == threshold


def element_rows(df: DataFrame, array: str, predicate: Predicate, keep: Sequence[str]) -> DataFrame:
    """One row per matching element: ``keep…, pos, element``; ``pos`` is the place in the stored array."""
    return df.select(*keep, F.posexplode(array).alias("pos", "element")).filter(predicate(F.col("element")))


def text_match(c: Column | str, words: str) -> Column:
    """True when the text holds at least one of the words, compared as tokens."""
    return F.coalesce(F.arrays_overlap(tokenize(c), tokenize(F.lit(words))), F.lit(False))

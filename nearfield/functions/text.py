"""Text analysis: lower-cased runs of letters and digits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what separates tokens.
SEPARATOR = r"[^\p{L}\p{N}]+"


def tokenize(c: Column | str) -> Column:
    """Tokens in reading order, repeats kept."""
    c = F.col(c) if isinstance(c, str) else c
    return F.array_remove(F.split(F.lower(c), SEPARATOR), "")


def token_count(c: Column | str) -> Column:
    return F.size(tokenize(c))

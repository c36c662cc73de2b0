"""Vector functions on arrays, in double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def normalised(a) -> Column:
    n = norm(a)
    return F.transform(a, lambda x: x.cast("double") / F.when(n == 0, 1.0).otherwise(n))


def cosine(a, b) -> Column:
    """0 for empty vectors, unequal lengths and zero norms."""
    ok = (F.size(a) > 0) & (F.size(a) == F.size(b)) & (norm(a) > 0) & (norm(b) > 0)
    return F.when(ok, dot(a, b) / (norm(a) * norm(b))).otherwise(0.0)


def semantic_score(cos) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), (cos + 1) / 2))

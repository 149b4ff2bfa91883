"""Vector arithmetic on ``array<float>`` columns, in double precision."""

from pyspark.sql import Column, functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
        F.lit(0.0),
        lambda s, x: s + x,
    )


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine_similarity(a: Column, b: Column) -> Column:
    """Cosine; a zero vector is similar to nothing (0.0)."""
    length = norm(a) * norm(b)
    return F.when(a.isNotNull() & b.isNotNull(), F.coalesce(F.try_divide(dot(a, b), length), F.lit(0.0)))

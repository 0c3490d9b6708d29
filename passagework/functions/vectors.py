"""Vector expressions on array<float> columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .binding import let

# Fixed value: stands in for a zero norm.
ZERO_NORM = 1e-10


def inner_product(a: Column, b: Column) -> Column:
    """Sum of products, accumulated in double."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def l2_norm(vector: Column) -> Column:
    return F.sqrt(
        F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    )


def l2_normalize(vector: Column) -> Column:
    """Unit vector as array<float>; a zero vector stays zero."""

    def scaled(norm):
        safe = F.when(norm == 0, F.lit(ZERO_NORM)).otherwise(norm)
        return F.transform(vector, lambda x: (x.cast("double") / safe).cast("float"))

    return let(l2_norm(vector), scaled)

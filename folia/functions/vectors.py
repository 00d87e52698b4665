"""Cosine similarity of two vector columns."""

from pyspark.sql import Column, functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(a: Column) -> Column:
    return F.sqrt(
        F.aggregate(a, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    )


def cosine_similarity(a: Column, b: Column) -> Column:
    """NaN where a vector is zero, NULL where one is NULL."""
    length = norm(a) * norm(b)
    nan = F.lit(float("nan"))
    return F.when(length == 0, nan).otherwise(dot(a, b) / F.nullif(length, F.lit(0.0)))

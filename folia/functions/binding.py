"""Naming an intermediate value inside an expression."""

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    Without it an expression used several times, above all inside the lambda of
    a higher-order function, would be evaluated at each use.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))

"""Small helpers shared by the operators of this package."""

import functools
import operator

from pyspark.sql import Column, DataFrame, Window, functions as F

from folia.session import materialise


def with_text(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id, text`` and the named columns; a NULL text is empty, other columns go."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text, *more)


def fresh(frame: DataFrame, name: str) -> str:
    """The name, or a longer one that no column of the frame has."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def usable_vectors() -> Column:
    """True for vectors that are not NULL, not zero and all of finite numbers."""
    value = F.col("embedding")
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(value.isNotNull() & finite & F.exists(value, lambda x: x != 0), F.lit(False))


def staged(frame: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared scratch folder and read back."""
    return materialise(frame, name)


def running_offsets(totals: DataFrame, by: list[str], sums: list[str]) -> DataFrame:
    """For rows of per-partition totals: the sums of all rows before each one.

    ``totals`` has one row per partition (and group), so the window over it stays small.
    """
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifted = [F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_before_{c}") for c in sums]
    return totals.select("_part", *by, *shifted)


def same(left: DataFrame, right: DataFrame, *keys: str) -> Column:
    """Null-safe equality of the key columns of two frames."""
    return functools.reduce(operator.and_, (left[k].eqNullSafe(right[k]) for k in keys))

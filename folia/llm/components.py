"""Connected components of a graph given as a table of links.

Each round, every node takes the neighbour (or itself) that comes first in an order drawn
anew for the round, chains of choices are followed twice, and the links are drawn between
the chosen nodes. Fewer nodes by a constant share are left after each round, so the number
of rounds grows with the logarithm of the graph. Links and choices are written to the shared
folder after each round; nothing is collected.
"""

from pyspark.sql import DataFrame, functions as F

from folia.llm.frames import staged

_MOST_ROUNDS = 100


def _moved(frame: DataFrame, column: str, choice: DataFrame) -> DataFrame:
    """Replace the nodes in a column by their choices; nodes without one stay."""
    found = choice.select(F.col("node").alias("_node"), F.col("chosen").alias("_chosen"))
    joined = frame.join(found, F.col(column) == F.col("_node"), "left")
    return joined.withColumn(column, F.coalesce("_chosen", column)).drop("_node", "_chosen")


def components(links: DataFrame) -> DataFrame:
    """``node, component`` of all nodes in ``links`` (columns ``a`` and ``b``).

    The component is named by one of its nodes. Links of a node to itself and with NULL
    are ignored, repeated ones count once; without links there are no rows.
    """
    links = links.select("a", "b").where(F.col("a") != F.col("b"))
    links = staged(links.distinct(), "links")
    choices: list[DataFrame] = []
    for number in range(_MOST_ROUNDS):
        if links.isEmpty():
            break
        both = links.union(links.select("b", "a"))
        ranked = both.select(
            F.col("a").alias("node"), F.struct(F.xxhash64("b", F.lit(number)), "b").alias("other")
        )
        first = ranked.groupBy("node").agg(F.min("other").alias("other"))
        own = F.struct(F.xxhash64("node", F.lit(number)), F.col("node").alias("b"))
        choice = staged(
            first.select("node", F.least(own, F.col("other"))["b"].alias("chosen")), "choice"
        )
        jumped = _moved(choice, "chosen", choice)
        choice = staged(_moved(staged(jumped, "jump"), "chosen", choice), "choice")
        choices.append(choice)
        moved = _moved(_moved(links, "a", choice), "b", choice).where(F.col("a") != F.col("b"))
        links = staged(moved.distinct(), "links")
    else:
        raise RuntimeError("components did not settle")
    if not choices:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    result = choices[0]
    for choice in choices[1:]:
        result = _moved(result, "chosen", choice)
    return staged(result.withColumnRenamed("chosen", "component"), "components")

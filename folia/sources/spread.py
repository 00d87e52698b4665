"""Work for all cores from few input files."""

from pyspark.sql import DataFrame


def spread(frame: DataFrame, *keys: str) -> DataFrame:
    """Repartition by keys, for the small tables of the registered queries.

    The text functions cost far more than moving the text once. The plans do not use this:
    a large table has scan partitions enough.
    """
    return frame.repartition(frame.sparkSession.sparkContext.defaultParallelism, *keys)

"""Groups of rows that stand together in a sorted partition."""

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame


def sorted_by(frame: DataFrame, key: str, *more: str) -> DataFrame:
    """Rows with an equal key in one partition, one after the other."""
    return frame.repartition(key).sortWithinPartitions(key, *more)


def whole_groups(
    batches: Iterator[pa.RecordBatch], key: str, least: int = 20_000
) -> Iterator[pa.Table]:
    """Tables of at least ``least`` rows (but for the last) that cut no run of equal keys.

    What is held at a time is ``least`` rows and the largest group.
    """
    held: list[pa.RecordBatch] = []
    rows, wanted = 0, least
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows < wanted:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        column = table.column(key)
        start = pc.index(column, column[rows - 1]).as_py()
        if start:
            yield table.slice(0, start)
        held, rows = table.slice(start).to_batches(), rows - start
        wanted = max(least, 2 * rows)
    if rows:
        yield pa.Table.from_batches(held).combine_chunks()


def borders(keys: list) -> list[int]:
    """Where runs of equal keys start, and the end."""
    return [i for i in range(len(keys)) if not i or keys[i] != keys[i - 1]] + [len(keys)]

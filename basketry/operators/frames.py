"""Small DataFrame helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a task in a table that a model reads again and again.
ROWS_A_TASK = 50_000


def combine_rows(*frames: DataFrame) -> DataFrame:
    """Merge one-row aggregates with disjoint columns into a single row.

    A union (missing columns are NULL) followed by one global ``max`` per
    column: no cross join, and every input is already a single row.
    """
    merged = frames[0]
    for f in frames[1:]:
        merged = merged.unionByName(f, allowMissingColumns=True)
    return merged.agg(*[F.max(c).alias(c) for c in merged.columns])


def spread(written: DataFrame, rows_a_task: int = ROWS_A_TASK) -> DataFrame:
    """A checkpointed table, dealt anew over as many partitions as its rows need.

    Partitions that were merged by their bytes are few, and every iteration of a model
    would run on so many cores only.  A table that has enough of them stays as it is.
    """
    parts = -(-written.count() // rows_a_task)
    if parts <= written.rdd.getNumPartitions():
        return written
    return written.repartition(parts).checkpoint(eager=True)

"""Ordering of small report results."""

from __future__ import annotations

from pyspark.sql import DataFrame


def small_report(df: DataFrame, *order) -> DataFrame:
    """Sort a result whose size is bounded by label sets (regions x categories,
    channels, months, a LIMIT) inside one task.

    A global ``orderBy`` range-partitions its input, which costs a sampling
    job; for a few dozen aggregated rows one shuffle into one sorting task is
    cheaper, and the rows all go to the caller anyway. The shuffle stands
    behind the aggregate, so the aggregate itself keeps all of its tasks. Do
    not use it for results that grow with the data.
    """
    return df.repartition(1).sortWithinPartitions(*order)

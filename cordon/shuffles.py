"""Shuffles whose number of partitions follows the rows.

A fixed ``spark.sql.shuffle.partitions`` gives every task more rows as the data
grows, until its sorts and aggregates spill.  Steps that know how many rows they
move plan their shuffles for that many; adaptive execution still joins
partitions that turn out small.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Rows of a whole trip that one task sorts, about (some 130 MB).
ROWS_PER_TASK = 500_000

PARTITIONS = "spark.sql.shuffle.partitions"
#: Takes precedence over PARTITIONS in adaptive execution where it is set.
INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


@contextmanager
def shuffles_for(spark: SparkSession, rows: int | None) -> Iterator[None]:
    """Meanwhile, shuffles have a partition for every ROWS_PER_TASK of ``rows``,
    and never fewer than the session's own number (None: that number)."""
    wanted = -(-(rows or 0) // ROWS_PER_TASK)
    before = {k: v for k in (PARTITIONS, INITIAL) if (v := spark.conf.get(k, None)) is not None}
    raised = [k for k, v in before.items() if v.isdigit() and int(v) < wanted]
    for k in raised:
        spark.conf.set(k, str(wanted))
    try:
        yield
    finally:
        for k in raised:
            spark.conf.set(k, before[k])

"""Global order, running sums and neighbours without gathering the rows.

A window ordered over a whole table runs in one task. Here the engine deals the
rows into sorted ranges, which are written with their range id ``_range``; each
range is then a task's window, and what it needs from the ranges before it (an
offset or a last row) is one row per range. Since the sort key ends in a unique
column, a hot value spreads over ranges.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from promptframe.session import durable, shuffle_partitions

RANGE = "_range"
KEY = "_key"


def _sort_key(order: Sequence[Column | str]) -> Column:
    columns = [F.col(c) if isinstance(c, str) else c for c in order]
    return F.struct(*[c.alias(f"k{i}") for i, c in enumerate(columns)])


def with_range(df: DataFrame, order: Sequence[Column | str], ranges: int | None = None) -> DataFrame:
    """Add ``_key`` and ``_range``, written once.

    The engine's range partitioning deals the rows, and the partition a row
    came to is kept as a column, so the plan has no bounds in it and stays as
    short for thousands of ranges as for ten. The key ends in the row's place
    in the input: rows that agree in ``order`` spread over ranges too.
    """
    ranges = ranges or shuffle_partitions(df.sparkSession)
    keyed = df.withColumn(KEY, _sort_key([*order, F.monotonically_increasing_id()]))
    return durable(keyed.repartitionByRange(ranges, KEY).withColumn(RANGE, F.spark_partition_id()))


def by_range(ranged: DataFrame, ranges: int | None = None) -> DataFrame:
    """Send each range to its own task."""
    return ranged.repartitionById(ranges or shuffle_partitions(ranged.sparkSession), F.col(RANGE))


def range_offsets(ranged: DataFrame, **sums: Column) -> DataFrame:
    """Per range, each sum taken over all earlier ranges: one row per range."""
    totals = ranged.groupBy(RANGE).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    before = W.orderBy(RANGE).rowsBetween(W.unboundedPreceding, -1)
    return totals.select(RANGE, *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(n) for n in sums])


def running_sums_by_range(ranged: DataFrame, ranges: int, **sums: Column) -> DataFrame:
    """``running_sums`` for rows that already carry ``_key`` and ``_range``."""
    offsets = range_offsets(ranged, **sums).select(RANGE, *[F.col(n).alias(f"_off_{n}") for n in sums])
    here = W.partitionBy(RANGE).orderBy(KEY).rowsBetween(W.unboundedPreceding, W.currentRow)
    # One row per range on the right: bounded by the range count.
    placed = by_range(ranged, ranges).join(F.broadcast(offsets), RANGE)
    totals = [(F.col(f"_off_{n}") + F.sum(c).over(here)).alias(n) for n, c in sums.items()]
    return placed.select(*ranged.columns, *totals)


def running_sums(df: DataFrame, order: Sequence[Column | str], ranges: int | None = None, **sums: Column) -> DataFrame:
    """Add running totals up to and including each row in the global order."""
    ranges = ranges or shuffle_partitions(df.sparkSession)
    return running_sums_by_range(with_range(df, order, ranges), ranges, **sums).drop(RANGE, KEY)


def with_seq(df: DataFrame, order: Sequence[Column | str], name: str = "seq", ranges: int | None = None) -> DataFrame:
    """Number the rows 0, 1, 2, ... in the order of the given columns."""
    numbered = running_sums(df, order, ranges, **{name: F.lit(1).cast("bigint")})
    return numbered.withColumn(name, F.col(name) - 1)


def with_previous(
    df: DataFrame, order: Sequence[Column | str], previous: dict[str, str], ranges: int | None = None
) -> DataFrame:
    """Add columns of the preceding row in the global order: ``{new: column}``."""
    ranges = ranges or shuffle_partitions(df.sparkSession)
    ranged = with_range(df, order, ranges)
    carried = F.struct(*[F.col(c).alias(n) for n, c in previous.items()])
    # The last row of each range, then of the nearest earlier range that has rows.
    last = ranged.groupBy(RANGE).agg(F.max_by(carried, KEY).alias("_last"))
    edge = last.select(RANGE, F.lag("_last").over(W.orderBy(RANGE)).alias("_edge"))
    here = W.partitionBy(RANGE).orderBy(KEY)
    placed = by_range(ranged, ranges).join(F.broadcast(edge), RANGE)
    before = placed.withColumn("_before", F.coalesce(F.lag(carried).over(here), F.col("_edge")))
    return before.select(*df.columns, *[F.col(f"_before.{n}").alias(n) for n in previous])


def round_robin(seq: Column | str, n: int) -> Column:
    return F.pmod(F.col(seq) if isinstance(seq, str) else seq, F.lit(n)).cast("int")

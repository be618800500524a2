"""Packing of request lines into shards bounded by requests and bytes.

A shard closes when the next line would exceed either bound, so where a shard
starts depends on every line before it. The exact plan keeps this rule without
running over all lines in one task. Each range of lines is summarised: for
each of its first ``max_requests`` lines, which shard would be open at the end
of the range if a shard began at that line. Only those lines can be the first
start in a range. Summaries join in a tree of fixed fan-in, level by level up to
the whole, and the way down tells every unit, at last every range, the shard that
is open when it begins. Then all ranges place their starts side by side. No task
sees more than one range, or ``FAN_IN`` summaries of at most ``max_requests`` lines
each, whatever the number of lines.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from promptframe.functions.text import fingerprint
from promptframe.operators.ordering import (
    KEY,
    RANGE,
    by_range,
    range_offsets,
    running_sums_by_range,
    with_range,
    with_seq,
)
from promptframe.session import durable, shuffle_partitions

# Rows of a range, about.
ROWS_PER_RANGE = 200_000
# Default bounds of a shard.
MAX_REQUESTS = 50_000
MAX_BYTES = 190 * 1024 * 1024

# Summaries that are joined to one of the next level.
FAN_IN = 16

# A unit is a range, or so many units of the level before.
_HEAD = "unit int, pos long, end long, open_pos long, open_bytes long"
_ENTRY = "unit int, open_pos long, open_bytes long"


def _next_starts(end: np.ndarray, size: np.ndarray, max_requests: int, max_bytes: int) -> np.ndarray:
    """Per line, the line that starts the next shard if a shard starts here (``len`` if none does)."""
    here = np.arange(len(end))
    by_bytes = np.searchsorted(end, end - size + max_bytes, side="right")
    return np.minimum(np.maximum(by_bytes, here + 1), np.minimum(here + max_requests, len(end)))


def _summarise(max_requests: int, max_bytes: int):
    """Per range: its first lines with the shard open at its end if one starts there."""

    def run(lines: pd.DataFrame) -> pd.DataFrame:
        lines = lines.sort_values("pos")
        end, size = lines["end"].to_numpy(), lines["size"].to_numpy()
        following = _next_starts(end, size, max_requests, max_bytes)
        last = np.where(following < len(end), following, np.arange(len(end)))
        while not np.array_equal(last, last[last]):
            last = last[last]
        head = slice(0, max_requests)
        pos, range_id = lines["pos"].to_numpy(), int(lines[RANGE].iloc[0])
        return pd.DataFrame(
            {
                "unit": range_id,
                "pos": pos[head],
                "end": end[head],
                "open_pos": pos[last[head]],
                "open_bytes": (end - size)[last[head]],
            }
        )

    return run


def _advance(head: pd.DataFrame, open_pos, open_bytes, max_requests: int, max_bytes: int):
    """The open shards after a summarised stretch, given those before it."""
    end = head["end"].to_numpy()
    by_bytes = np.searchsorted(end, open_bytes + max_bytes, side="right")
    first = np.minimum(by_bytes, open_pos + max_requests - head["pos"].iloc[0])
    hit = first < len(end)
    at = np.where(hit, first, 0)
    return (
        np.where(hit, head["open_pos"].to_numpy()[at], open_pos),
        np.where(hit, head["open_bytes"].to_numpy()[at], open_bytes),
    )


def _children(heads: pd.DataFrame) -> Iterator[tuple[int, pd.DataFrame]]:
    return ((int(k), g) for k, g in heads.sort_values("pos").groupby("unit", sort=True))


def _merge(max_requests: int, max_bytes: int):
    """Summaries of neighbouring units to the summary of their parent."""

    def run(heads: pd.DataFrame) -> pd.DataFrame:
        parts = [g for _, g in _children(heads)]
        merged, taken = [], 0
        for i, part in enumerate(parts):
            if taken >= max_requests:
                break
            part = part.iloc[: max_requests - taken].copy()
            taken += len(part)
            open_pos, open_bytes = part["open_pos"].to_numpy(), part["open_bytes"].to_numpy()
            for later in parts[i + 1 :]:
                open_pos, open_bytes = _advance(later, open_pos, open_bytes, max_requests, max_bytes)
            part["open_pos"], part["open_bytes"] = open_pos, open_bytes
            part["unit"] = part["parent"]
            merged.append(part.drop(columns="parent"))
        return pd.concat(merged)

    return run


def _walk(max_requests: int, max_bytes: int):
    """The shard open at the begin of each child, in order.

    The open shard at the begin of the whole stretch is in the columns
    ``in_pos, in_bytes``; null where the stretch is the first.
    """

    def run(heads: pd.DataFrame) -> pd.DataFrame:
        entry = heads[["in_pos", "in_bytes"]].iloc[0]
        state = None if pd.isna(entry["in_pos"]) else (int(entry["in_pos"]), int(entry["in_bytes"]))
        found = []
        for child, head in _children(heads):
            found.append((child, *(state or (None, None))))
            if state is None:
                state = (head["open_pos"].iloc[0], head["open_bytes"].iloc[0])
            else:
                state = tuple(x[0] for x in _advance(head, np.array([state[0]]), np.array([state[1]]), max_requests, max_bytes))
        frame = pd.DataFrame(found, columns=["unit", "open_pos", "open_bytes"])
        return frame.astype({"unit": "int32", "open_pos": "Int64", "open_bytes": "Int64"})

    return run


def _place(max_requests: int, max_bytes: int):
    """Positions in a range at which a shard starts, given the shard open before it."""

    def run(lines: pd.DataFrame) -> pd.DataFrame:
        lines = lines.sort_values("pos")
        end, size, pos = (lines[c].to_numpy() for c in ("end", "size", "pos"))
        following = _next_starts(end, size, max_requests, max_bytes)
        at = 0
        if not pd.isna(lines["open_pos"].iloc[0]):
            open_pos, open_bytes = int(lines["open_pos"].iloc[0]), int(lines["open_bytes"].iloc[0])
            at = min(int(np.searchsorted(end, open_bytes + max_bytes, side="right")), open_pos + max_requests - int(pos[0]))
        starts = []
        while at < len(end):
            starts.append(at)
            at = int(following[at])
        return pd.DataFrame({RANGE: np.full(len(starts), lines[RANGE].iloc[0], dtype="int32"), "pos": pos[starts]})

    return run


def shard_starts(lines: DataFrame, ranges: int, max_requests: int, max_bytes: int) -> DataFrame:
    """``_range, pos`` of the lines that start a shard.

    ``lines`` has ``_range``, the line's position ``pos``, its bytes ``size``
    and the running total ``end`` up to and including it.
    """
    bounds = (max_requests, max_bytes)
    narrow = lines.select(F.col(RANGE).cast("int").alias(RANGE), "pos", "size", "end")
    parent = F.floor(F.col("unit") / FAN_IN).cast("int").alias("parent")
    # Up: a level has a FAN_IN-th of the units before it; a group is FAN_IN summaries of at most max_requests lines.
    levels = [durable(narrow.groupBy(RANGE).applyInPandas(_summarise(*bounds), _HEAD))]
    units = ranges
    while units > FAN_IN:
        levels.append(durable(levels[-1].select("*", parent).groupBy("parent").applyInPandas(_merge(*bounds), _HEAD)))
        units = -(-units // FAN_IN)
    # Down: the shard open at the begin of each unit, from that of its parent.
    none = F.lit(None).cast("long")
    heads = levels.pop().select("*", parent, none.alias("in_pos"), none.alias("in_bytes"))
    while True:
        entry = heads.groupBy("parent").applyInPandas(_walk(*bounds), _ENTRY)
        if not levels:
            break
        opened = entry.select(F.col("unit").alias("parent"), F.col("open_pos").alias("in_pos"), F.col("open_bytes").alias("in_bytes"))
        heads = levels.pop().select("*", parent).join(opened, "parent")
    # One row per range.
    placed = narrow.join(F.broadcast(entry.withColumnRenamed("unit", RANGE)), RANGE)
    return placed.groupBy(RANGE).applyInPandas(_place(*bounds), f"{RANGE} int, pos long")


def pack(
    df: DataFrame,
    order: Sequence[Column | str],
    size: Column,
    max_requests: int = MAX_REQUESTS,
    max_bytes: int = MAX_BYTES,
    ranges: int | None = None,
) -> DataFrame:
    """Add ``shard`` (1, 2, ...): consecutive rows in ``order`` within both bounds.

    A line larger than ``max_bytes`` is a shard of its own. ``order`` has to
    identify rows. Where no ``max_requests`` lines can exceed ``max_bytes``,
    the row number alone decides.
    """
    largest, rows = df.agg(F.max(size), F.count("*")).head()
    # A range's sizes are in one task's memory at a time, so ranges follow the rows.
    ranges = ranges or max(shuffle_partitions(df.sparkSession), -(-rows // ROWS_PER_RANGE))
    if largest is None or largest * max_requests <= max_bytes:
        numbered = with_seq(df, order, "_seq", ranges)
        return numbered.withColumn("shard", F.floor(F.col("_seq") / max_requests) + 1).drop("_seq")

    ranged = with_range(df, order, ranges)
    sizes = ranged.select(RANGE, KEY, size.cast("bigint").alias("size"))
    lines = running_sums_by_range(sizes, ranges, pos=F.lit(1).cast("bigint"), end=F.col("size"))
    lines = durable(lines.withColumn("pos", F.col("pos") - 1))
    starts = durable(shard_starts(lines, ranges, max_requests, max_bytes))

    # A marker row ahead of each starting row: the markers seen so far number the shard.
    # However many shards there are, nothing but one row per range is broadcast.
    markers = lines.join(starts, [RANGE, "pos"]).select(RANGE, KEY, F.lit(1).alias("_start"))
    rows = ranged.withColumn("_start", F.lit(0)).unionByName(markers, allowMissingColumns=True)
    before = range_offsets(lines.select(RANGE, F.lit(0).alias("n")).union(starts.select(RANGE, F.lit(1))), _before=F.col("n"))
    here = W.partitionBy(RANGE).orderBy(F.col(KEY), F.col("_start").desc())
    here = here.rowsBetween(W.unboundedPreceding, W.currentRow)
    placed = by_range(rows, ranges).join(F.broadcast(before), RANGE)
    shard = F.col("_before") + F.sum("_start").over(here)
    numbered = placed.withColumn("shard", shard).where(F.col("_start") == 0)
    return numbered.select(*df.columns, "shard")


def review_summary(packed: DataFrame, size: Column) -> DataFrame:
    """``shard, requests, bytes`` per shard; the null shard is the total."""
    return packed.rollup("shard").agg(F.count("*").alias("requests"), F.sum(size).alias("bytes"))


def write_shards(packed: DataFrame, line: Column, folder: str, order: Sequence[Column | str]) -> None:
    """One file of JSONL lines per shard under ``shard=<n>``; old shards are replaced."""
    lines = packed.select("shard", *[F.col(c) if isinstance(c, str) else c for c in order], line.alias("value"))
    by_shard = lines.repartition("shard").sortWithinPartitions("shard", *order)
    by_shard.select("value", "shard").write.mode("overwrite").partitionBy("shard").text(folder)


def shard_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """``shard, path, bytes, sha256, batch_id`` of the written shard files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    shard = F.regexp_extract("path", r"shard=(\d+)", 1).cast("long")
    return files.where(F.col("path").rlike(r"/shard=\d+/[^/]+$")).select(
        shard.alias("shard"),
        "path",
        F.col("length").alias("bytes"),
        F.sha2("content", 256).alias("sha256"),
        fingerprint("content", "batch_").alias("batch_id"),
    )

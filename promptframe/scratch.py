"""Step tables of one job, in the shared folder, and row numbers made from them."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from promptframe.session import configure, ensure_checkpoint_dir


class Scratch:
    """Parquet tables below the shared checkpoint folder that cut lineage and outlive executors.

    ``with`` deletes, at its end, every table but those named in ``keep``;
    a frame that is returned to the caller must read kept tables only.
    """

    def __init__(self, spark: SparkSession, name: str, keep: tuple[str, ...] = ()):
        configure(spark)
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.keep, self.paths = set(keep), {}

    def store(self, df: DataFrame, label: str) -> DataFrame:
        """Write ``df`` once and go on from the files."""
        path = self.paths[label] = f"{self.root}/{label}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *labels: str) -> None:
        for label in labels:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop(label))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def settle(self) -> None:
        """Let Spark's cleaner remove the shuffle files of steps that are written and no longer referred to.

        The cleaner acts when the driver collects garbage, which it may not do
        for long while executors' disks fill.
        """
        gc.collect()
        self.spark._jvm.System.gc()

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *problem) -> None:
        self.drop(*[x for x in self.paths if x not in self.keep])


def numbered(scratch: Scratch, df: DataFrame, order: list[Column], name: str, label: str, ranges: int) -> DataFrame:
    """``df`` with the global row number ``name`` from 0 in ``order``, without one task for all rows.

    The engine deals the rows into sorted ranges, which are written once with
    their partition id; the rows before each range are then one number a
    range. ``order`` must be unique for the numbers to be the same on reruns.
    """
    spread = df.repartitionByRange(max(1, ranges), *order).sortWithinPartitions(*order)
    # The upper bits are the partition, the lower 33 the place in it.
    placed = scratch.store(spread.withColumn(name, F.monotonically_increasing_id()), label)
    part = F.shiftright(F.col(name), 33)
    counts = placed.groupBy(part.alias("part")).count().collect()
    before, starts = 0, {}
    for row in sorted(counts):
        starts[row["part"]] = before
        before += row["count"]
    if not starts:
        return placed
    offsets = df.sparkSession.createDataFrame(sorted(starts.items()), "_part long, _before long")
    place = F.col(name).bitwiseAND(F.lit((1 << 33) - 1)) + F.col("_before")
    joined = placed.join(F.broadcast(offsets), part == F.col("_part"))
    return joined.select(*[place.alias(c) if c == name else F.col(f"`{c}`") for c in placed.columns])

"""Scores written while they are made: a sink that calls the model and commits block by block.

A job's log is a folder of runs. Within a run every task writes the requests of
its partition in blocks of a fixed number of rows, named by partition and place,
each put in place by one rename; a retry of the task finds the blocks that are
there and goes on behind them. A task's commit message names its blocks, and the
run ends in a list of them.

A new run first closes the runs before it: their folder is moved from ``open`` to
``closed``, so tasks of a dead run that still write can no longer add to what is
read. Requests with a row in a closed run are not sent again. So each request is
scored at most once for each time a block's writing is cut off, and has exactly
one row in the log, wherever a task or the driver is stopped.
"""

from __future__ import annotations

import json
import posixpath
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from promptframe.sources.storage import exists, make_folder, move, names_in

NAME = "promptframe_scores"
OPEN, CLOSED = "open", "closed"
# Requests whose scores become durable together.
ROWS_PER_BLOCK = 1000


@dataclass
class Blocks(WriterCommitMessage):
    partition: int
    rows: int
    names: list[str]


def _storage(folder: str) -> tuple[fs.FileSystem, str]:
    """The folder's file system in a worker, and the path in it."""
    if "://" in folder or folder.startswith("file:"):
        return fs.FileSystem.from_uri(folder.replace("file:///", "file:/").replace("file:/", "file:///"))
    return fs.LocalFileSystem(), folder


class BlockWriter(DataSourceArrowWriter):
    def __init__(self, folder: str, score: Callable[[list[dict]], list[tuple]], schema: pa.Schema, block_rows: int):
        self.folder, self.score, self.schema, self.block_rows = folder, score, schema, block_rows

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Blocks:
        from pyspark import TaskContext

        context = TaskContext.get()
        partition = context.partitionId()
        storage, path = _storage(self.folder)
        done, names, pending = 0, [], []

        def commit(rows: list[dict]) -> None:
            name = f"{partition:06d}-{len(names):06d}.parquet"
            final = posixpath.join(path, name)
            if storage.get_file_info(final).type == fs.FileType.NotFound:
                columns = list(zip(*self.score(rows)))
                table = pa.table([pa.array(c, t.type) for c, t in zip(columns, self.schema)], schema=self.schema)
                # Spark does not read names that begin with an underscore.
                draft = posixpath.join(path, f"_{context.taskAttemptId()}-{name}")
                with storage.open_output_stream(draft) as out:
                    pq.write_table(table, out, compression="zstd")
                try:
                    storage.move(draft, final)
                except OSError:
                    # Another attempt of this task was first, with the same requests.
                    if storage.get_file_info(final).type == fs.FileType.NotFound:
                        raise
                    storage.delete_file(draft)
            names.append(name)

        for batch in iterator:
            pending += batch.to_pylist()
            while len(pending) >= self.block_rows:
                commit(pending[: self.block_rows])
                done, pending = done + self.block_rows, pending[self.block_rows :]
        if pending:
            commit(pending)
            done += len(pending)
        return Blocks(partition, done, names)

    def commit(self, messages: list[Blocks | None]) -> None:
        told = [{"partition": m.partition, "rows": m.rows, "blocks": m.names} for m in messages if m]
        storage, path = _storage(self.folder)
        with storage.open_output_stream(posixpath.join(path, "_blocks.json")) as out:
            out.write(json.dumps(told).encode())

    def abort(self, messages: list[Blocks | None]) -> None:
        """Blocks that are in place stay: the next run counts them."""


def sink(score: Callable[[list[dict]], list[tuple]], schema: pa.Schema) -> type[DataSource]:
    """A data source whose writer sends its rows through ``score``."""

    class Scores(DataSource):
        @classmethod
        def name(cls) -> str:
            return NAME

        def writer(self, schema_of_rows, overwrite: bool) -> BlockWriter:
            return BlockWriter(self.options["path"], score, schema, int(self.options["block_rows"]))

    return Scores


def close_runs(spark: SparkSession, folder: str) -> int:
    """Move what earlier runs left to ``closed``; the number of the next run."""
    for name in names_in(spark, f"{folder}/{OPEN}"):
        make_folder(spark, f"{folder}/{CLOSED}")
        move(spark, f"{folder}/{OPEN}/{name}", f"{folder}/{CLOSED}/{name}")
    return 1 + max((int(n.split("-")[1]) for n in names_in(spark, f"{folder}/{CLOSED}")), default=0)


def read_log(spark: SparkSession, folder: str, schema: str) -> DataFrame | None:
    """The rows of all closed runs, None before the first."""
    runs = [f"{folder}/{CLOSED}/{n}" for n in names_in(spark, f"{folder}/{CLOSED}")]
    filled = [r for r in runs if any(n.endswith(".parquet") and not n.startswith("_") for n in names_in(spark, r))]
    return spark.read.schema(schema).parquet(*filled) if filled else None


def append_run(rows: DataFrame, folder: str, run: int, source: type[DataSource], block_rows: int = ROWS_PER_BLOCK) -> None:
    """Send ``rows``, in the order of their partitions, through the sink as one run."""
    spark = rows.sparkSession
    target = f"{folder}/{OPEN}/run-{run:06d}"
    if exists(spark, target):
        raise ValueError(f"{target} is written by another job")
    make_folder(spark, target)
    spark.dataSource.register(source)
    rows.write.format(NAME).option("path", target).option("block_rows", block_rows).mode("append").save()

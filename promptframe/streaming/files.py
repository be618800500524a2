"""Folders that keep filling: the same row steps on a file stream.

Rendering and validation look at one row at a time, so they run on a stream
without state; the sink's checkpoint makes each file count once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promptframe.functions.text import strip
from promptframe.operators.contract import Contract
from promptframe.operators.validate import parse_outputs, validate_outputs
from promptframe.plans.job import clean_documents, requests_of
from promptframe.plans.recipes import Recipe
from promptframe.sources.documents import file_name

_FILES = "path string, modificationTime timestamp, length long, content binary"


def stream_documents(spark: SparkSession, folder: str, recipe: Recipe, files_per_batch: int = 10_000) -> DataFrame:
    """Parsed documents of a folder as they arrive."""
    files = spark.readStream.format("binaryFile").schema(_FILES).option("maxFilesPerTrigger", files_per_batch)
    named = files.load(folder).withColumn("custom_id", file_name("path")).where(recipe.reader.accepts(F.col("custom_id")))
    return recipe.reader.parse(named.select("custom_id", "path", "length", "content"))


def stream_requests(documents: DataFrame, recipe: Recipe, model: str, instructions: str) -> DataFrame:
    """Request rows of the streamed documents that pass the filters."""
    return requests_of(clean_documents(documents, recipe).documents, recipe, model, instructions)


def stream_answers(spark: SparkSession, folder: str, contract: Contract | None = None) -> DataFrame:
    """Checked answers of the answer files of a folder as they arrive."""
    lines = spark.readStream.text(folder).select(F.col("value").alias("line"))
    return validate_outputs(parse_outputs(lines.where(F.length(strip("line")) > 0)), contract)


def write_stream(df: DataFrame, folder: str, checkpoint: str, once: bool = False):
    """Start writing to parquet; ``once`` takes what is there and ends."""
    writer = df.writeStream.format("parquet").option("path", folder).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()

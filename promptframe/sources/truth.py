"""Ground truth: a two-column CSV and a prefix-to-label map."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from promptframe.functions.text import strip
from promptframe.sources.quoted import joined_records

_CELLS = "filename string, label string, _bad string"


def _looks_like_header(cell: Column) -> Column:
    return F.regexp_replace(cell, "[_ -]", "").rlike(r"^\p{L}+$")


def last_label_wins(rows: DataFrame, order: Column) -> DataFrame:
    """One label per file name: the one with the greatest ``order``.

    ``max_by`` combines on the map side, so repeated names never gather.
    """
    label = F.lower(strip(F.coalesce(F.col("label"), F.lit(""))))
    named = rows.select(strip("filename").alias("filename"), label.alias("label"), order.alias("_order"))
    named = named.where(F.col("filename") != "")
    return named.groupBy("filename").agg(F.max_by("label", "_order").alias("label"))


def read_truth_csv(spark: SparkSession, path: str, header: bool | None = None) -> DataFrame:
    """``filename, label`` of a CSV, one row per file name.

    ``header=None`` takes a first row of two purely alphabetic cells for a
    header. The file is read in splits, also where quoted cells hold line feeds.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    lines = spark.read.text(path)
    spans = bool(lines.where(quotes % 2 == 1).take(1))
    order = F.struct(
        F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()
    )
    options = {"escape": '"', "columnNameOfCorruptRecord": "_bad"}
    if spans:
        records = joined_records(lines.select("value", F.col("_metadata.file_path").alias("file"), order.alias("o")), F.col("o"))
        # Blank lines are no records.
        records = records.where(F.length(strip("value")) > 0)
        cells = records.select(F.from_csv("value", _CELLS, options).alias("c"), "_order").select("c.*", "_order")
    else:
        cells = spark.read.schema(_CELLS).option("header", False).options(**options).csv(path).withColumn("_order", order)
    # A row without a second cell is corrupt and has no label; an empty label is not corrupt.
    missing = F.col("label").isNull() & F.col("_bad").isNotNull()
    if header is None:
        first = cells.orderBy("_order").limit(1)
        alphabetic = _looks_like_header(F.col("filename")) & _looks_like_header(F.col("label"))
        header = bool(first.where(alphabetic & ~missing).take(1))
    if header:
        top = cells.agg(F.min("_order").alias("top")).head().top
        here = [F.col("_order")[name] == value for name, value in zip(["file_path", "file_block_start", "col3"], top)]
        cells = cells.where(~(here[0] & here[1] & here[2]))
    return last_label_wins(cells.where(~missing & F.col("filename").isNotNull()), F.col("_order"))


def prefix_map(spark: SparkSession, mapping: dict[str, str]) -> DataFrame:
    """``prefix, label``: the first of several keys equal in lower case wins."""
    first: dict[str, str] = {}
    for key, value in mapping.items():
        first.setdefault(key.lower(), value)
    return spark.createDataFrame(list(first.items()), "prefix string, label string")


def read_prefix_map(spark: SparkSession, path: str) -> DataFrame:
    """The prefix map of a JSON object file."""
    text = spark.read.option("wholetext", True).text(path).head().value
    return prefix_map(spark, json.loads(text))

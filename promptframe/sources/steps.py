"""Step tables: the durable form of a job's intermediate results."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promptframe.functions.answers import parse_whole
from promptframe.sources.storage import read_text


def write_step(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write a step as parquet and return the written table.

    Variant columns are stored as they are.
    """
    df.write.mode("overwrite").parquet(f"{folder}/{name}")
    return read_step(df.sparkSession, folder, name)


def read_step(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}")


def is_complete(spark: SparkSession, folder: str) -> bool:
    """Whether a write to the folder has been committed."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    return marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker)


def read_validated_json(spark: SparkSession, path: str, contract_id: str = "filename") -> DataFrame:
    """Validated rows from JSON lines: ``custom_id, data, raw_text``."""
    lines = spark.read.text(path).select(F.col("value").alias("raw_text"), parse_whole("value").alias("data"))
    custom_id = F.try_variant_get("data", f"$.{contract_id}", "string")
    return lines.where(F.col("data").isNotNull()).select(custom_id.alias("custom_id"), "data", "raw_text")


def read_evaluation(spark: SparkSession, path: str) -> dict:
    """A saved evaluation; class ratios are derived again from the counts."""
    text = read_text(spark, path)
    if text is None:
        raise FileNotFoundError(f"no evaluation {path}")
    saved = json.loads(text)
    for row in saved.get("per_class", []):
        tp, fp, fn = (row.get(k, 0) for k in ("tp", "fp", "fn"))
        row["support"] = tp + fn
        row["precision"] = tp / (tp + fp) if tp + fp else 0.0
        row["recall"] = tp / (tp + fn) if tp + fn else 0.0
        total = row["precision"] + row["recall"]
        row["f1"] = 2 * row["precision"] * row["recall"] / total if total else 0.0
    return saved


def append_rows(df: DataFrame, folder: str) -> None:
    """Append summary or manifest rows of a batch to a parquet table."""
    df.write.mode("append").parquet(folder)


def put_rows(df: DataFrame, folder: str, keys: Sequence[str]) -> None:
    """Write rows in place of all earlier ones that agree in ``keys``, whose values name the folders.

    Writing the same rows again changes nothing, so a rerun adds none.
    """
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(folder)

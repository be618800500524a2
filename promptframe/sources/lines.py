"""JSONL request and answer files as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from promptframe.functions.answers import as_string, parse_whole
from promptframe.functions.frames import compute_once
from promptframe.functions.text import strip

# Files beside the answers that hold none.
NO_ANSWERS = ["errors.jsonl", "status_history.jsonl"]

_PARTS = "array<struct<role:variant,content:array<variant>>>"


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``line, file`` of the non-blank lines of text files."""
    lines = spark.read.text(paths).select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"))
    return lines.where(F.length(strip("line")) > 0)


def read_outputs(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of the answer files of a job.

    A file or folder named ``output.jsonl`` is preferred; else every ``*.jsonl`` there is
    read but for those named in ``NO_ANSWERS``.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = sorted(s.getPath().getName() for s in fs.listStatus(path))
    chosen = [n for n in names if n == "output.jsonl"] or [
        n for n in names if n.endswith(".jsonl") and n not in NO_ANSWERS
    ]
    if not chosen:
        raise FileNotFoundError(f"no answer files in {folder}")
    return read_lines(spark, [f"{folder}/{n}" for n in chosen])


def parse_requests(lines: DataFrame, line: str = "line") -> DataFrame:
    """Request lines to typed rows.

    ``malformed`` marks lines that are no JSON. Content parts given as bare
    strings become ``input_text`` parts.
    """
    rows = compute_once(lines, _v=parse_whole(F.col(line)))
    v = F.col("_v")

    def text(path: str) -> Column:
        return F.try_variant_get(v, path, "string")

    def variant(path: str) -> Column:
        return F.try_variant_get(v, path, "variant")

    def part(p: Column) -> Column:
        bare = F.schema_of_variant(p) == "STRING"
        kind = F.when(bare, F.lit("input_text")).otherwise(F.try_variant_get(p, "$.type", "string"))
        value = F.when(bare, as_string(p)).otherwise(F.try_variant_get(p, "$.text", "string"))
        return F.struct(kind.alias("type"), F.coalesce(value, F.lit("")).alias("text"))

    def item(i: Column) -> Column:
        parts = F.transform(F.coalesce(i["content"], F.array().cast("array<variant>")), part)
        return F.struct(F.coalesce(as_string(i["role"]), F.lit("user")).alias("role"), parts.alias("content"))

    # The list is read once; each part is then taken as what it is.
    items = F.transform(F.try_variant_get(v, "$.body.input", _PARTS), item)
    fmt = F.when(
        variant("$.body.text.format").isNotNull(),
        F.struct(
            text("$.body.text.format.type").alias("type"),
            text("$.body.text.format.name").alias("name"),
            F.to_json(variant("$.body.text.format.schema")).alias("schema"),
            F.try_variant_get(v, "$.body.text.format.strict", "boolean").alias("strict"),
        ),
    )
    return rows.select(
        *lines.columns,
        text("$.custom_id").alias("custom_id"),
        text("$.method").alias("method"),
        text("$.url").alias("url"),
        F.struct(
            text("$.body.model").alias("model"),
            text("$.body.instructions").alias("instructions"),
            items.alias("input"),
            F.struct(fmt.alias("format")).alias("text"),
        ).alias("body"),
        v.isNull().alias("malformed"),
    )

"""Answer lines to checked answers: status, data and message per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptframe.functions.answers import as_string, member, parse_whole
from promptframe.functions.frames import compute_once
from promptframe.operators.contract import Contract

_OUTPUT = "array<struct<type:string,content:array<struct<type:string,text:string>>>>"


def output_texts(output: Column) -> Column:
    """The output texts of the message items, in order."""
    messages = F.filter(output, lambda i: i["type"] == "message")
    parts = F.flatten(F.transform(messages, lambda i: F.coalesce(i["content"], F.array())))
    wanted = F.filter(parts, lambda p: (p["type"] == "output_text") & p["text"].isNotNull())
    return F.transform(wanted, lambda p: p["text"])


def first_text(texts: Column) -> Column:
    """The first text that is not empty, else ``""`` if there is one at all, else null."""
    return F.coalesce(F.get(F.filter(texts, lambda t: t != ""), F.lit(0)), F.get(texts, F.lit(0)))


def parse_outputs(lines: DataFrame, line: str = "line") -> DataFrame:
    """Answer lines to ``custom_id, error, raw_text, malformed``."""
    rows = compute_once(lines, _v=parse_whole(F.col(line)))
    v = F.col("_v")
    rows = compute_once(rows, _error=member(v, "error"), _texts=output_texts(_typed_output(v)))
    return rows.select(
        *lines.columns,
        F.coalesce(as_string(member(v, "custom_id")), F.lit("")).alias("custom_id"),
        F.to_json(F.when(~F.is_variant_null("_error"), F.col("_error"))).alias("error"),
        first_text(F.col("_texts")).alias("raw_text"),
        v.isNull().alias("malformed"),
    )


def _typed_output(record: Column) -> Column:
    """The output items of a record, with members of another type as null.

    Records as they should be take one typed read; only the others are read
    member by member.
    """
    items = F.try_variant_get(record, "$.response.body.output", "array<variant>")

    def part(p: Column) -> Column:
        return F.struct(as_string(member(p, "type")).alias("type"), as_string(member(p, "text")).alias("text"))

    def item(i: Column) -> Column:
        content = F.try_variant_get(i, "$.content", "array<variant>")
        return F.struct(as_string(member(i, "type")).alias("type"), F.transform(content, part).alias("content"))

    return F.coalesce(F.try_variant_get(record, "$.response.body.output", _OUTPUT), F.transform(items, item))


def records_as_outputs(records: DataFrame) -> DataFrame:
    """Typed output records in the form of ``parse_outputs``, without a trip through text."""
    read = compute_once(records, _texts=output_texts(F.col("response.body.output")))
    return read.select(
        "custom_id",
        F.to_json("error").alias("error"),
        first_text(F.col("_texts")).alias("raw_text"),
        F.lit(False).alias("malformed"),
    )


def validate_outputs(outputs: DataFrame, contract: Contract | None = None, malformed: str = "quarantine") -> DataFrame:
    """``custom_id, status, data, message, raw_text`` per answer.

    Status is skipped (error record, or no text), invalid (no JSON, or against
    the contract) or valid. Lines that are no JSON records have status
    malformed, or fail the job with ``malformed="fail"``. ``data`` is the
    parsed answer as given, not coerced.
    """
    parsed = compute_once(outputs, data=parse_whole(F.col("raw_text")))
    data = F.col("data")
    if contract:
        parsed = contract.check(parsed, "data", "_fits", "_broken")
    else:
        parsed = parsed.withColumns({"_fits": F.lit(True), "_broken": F.array().cast("array<string>")})
    fits, broken = F.col("_fits"), F.col("_broken")
    is_bad_line = F.col("malformed")
    if malformed == "fail":
        is_bad_line = F.when(is_bad_line, F.raise_error(F.lit("answer line is no JSON")).cast("boolean")).otherwise(False)
    text_missing = F.col("raw_text").isNull()
    status = (
        F.when(is_bad_line, "malformed")
        .when(F.col("error").isNotNull() | text_missing, "skipped")
        .when(data.isNull() | ~fits, "invalid")
        .otherwise("valid")
    )
    checked = parsed.withColumn("status", status)
    message = (
        F.when(F.col("status") == "valid", F.lit(None).cast("string"))
        .when(F.col("status") == "malformed", F.lit("line is no JSON record"))
        .when(F.col("error").isNotNull(), F.concat(F.lit("Batch error: "), F.col("error")))
        .when(text_missing, F.lit("Could not extract output text from response"))
        .when(data.isNull(), F.lit("JSON parse error"))
        .otherwise(F.concat(F.lit("Schema validation error: "), F.array_join(broken, "; ")))
    )
    return checked.select("custom_id", "status", "data", message.alias("message"), "raw_text")


def validation_counts(checked: DataFrame) -> DataFrame:
    """``status, n`` with the total under ``total``."""
    counts = checked.rollup("status").agg(F.count("*").alias("n"))
    return counts.select(F.coalesce("status", F.lit("total")).alias("status"), "n")


def valid_rows(checked: DataFrame) -> DataFrame:
    """``custom_id, data, raw_text`` of the valid answers."""
    return checked.where(F.col("status") == "valid").select("custom_id", "data", "raw_text")


def quarantine(checked: DataFrame) -> DataFrame:
    """``custom_id, status, message, raw_text`` of all other answers."""
    return checked.where(F.col("status") != "valid").select("custom_id", "status", "message", "raw_text")

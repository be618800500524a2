"""Documents to request rows, and request rows to chat payloads."""

from __future__ import annotations

import json
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promptframe.functions.text import json_quote
from promptframe.operators.contract import sanitise_json_schema

# Fixed values of the request format.
ENDPOINT = "/v1/responses"
METHOD = "POST"
PACKAGED_HEADERS = ["From", "To", "Subject", "Date", "Reply-To"]


def package_text(headers: str = "headers", body: str = "body", max_chars: int | None = None) -> Column:
    """Header lines, a blank line and the body.

    The body is sent whole. With ``max_chars`` it is cut, and ``is_cut`` tells
    which rows that changes.
    """
    lines = [
        F.when(F.col(headers)[h] != "", F.concat(F.lit(f"{h}: "), F.col(headers)[h])) for h in PACKAGED_HEADERS
    ]
    text = F.coalesce(F.col(body), F.lit(""))
    if max_chars is not None:
        text = F.substring(text, 1, max_chars)
    return F.concat_ws("\n", *lines, F.lit(""), text)


def is_cut(max_chars: int, body: str = "body") -> Column:
    """Whether ``package_text`` leaves out a part of the body at this bound."""
    return F.coalesce(F.char_length(body) > max_chars, F.lit(False))


def with_attachments(base: Column, names: Column) -> Column:
    """Add the attachment section where there are attachments."""
    listed = F.array_join(F.transform(names, lambda n: F.concat(F.lit("  - "), n)), "\n")
    section = F.when(F.size(names) > 0, F.concat(F.lit("\n\nAttachments:\n"), listed))
    return F.concat(base, F.coalesce(section, F.lit("")))


def render_requests(
    df: DataFrame,
    text: Column,
    model: str,
    instructions: str,
    text_format: dict | None = None,
    custom_id: str = "custom_id",
    keep: list[str] | None = None,
) -> DataFrame:
    """One request per row: ``custom_id, method, url, body``.

    ``text_format`` is the contract block of ``Contract.text_format``; its JSON
    schema stays JSON text, so its key order is kept. Columns named in ``keep``
    go along.
    """
    part = F.struct(F.lit("input_text").alias("type"), text.alias("text"))
    item = F.struct(F.lit("user").alias("role"), F.array(part).alias("content"))
    fields = [F.lit(model).alias("model"), F.lit(instructions).alias("instructions"), F.array(item).alias("input")]
    if text_format is not None:
        fmt = text_format["format"]
        block = F.struct(
            F.lit(fmt["type"]).alias("type"),
            F.lit(fmt["name"]).alias("name"),
            F.lit(json.dumps(fmt["schema"])).alias("schema"),
            F.lit(fmt["strict"]).alias("strict"),
        )
        fields.append(F.struct(block.alias("format")).alias("text"))
    return df.select(
        *(keep or []),
        F.col(custom_id).alias("custom_id"),
        F.lit(METHOD).alias("method"),
        F.lit(ENDPOINT).alias("url"),
        F.struct(*fields).alias("body"),
    )


def override_prompt(requests: DataFrame, prompt: str | None) -> DataFrame:
    """Replace the instructions of every request; no change without a prompt."""
    if not prompt:
        return requests
    return requests.withColumn("body", F.col("body").withField("instructions", F.lit(prompt)))


def _has_text(requests: DataFrame) -> bool:
    return "text" in requests.schema["body"].dataType.names


def request_line(requests: DataFrame) -> Column:
    """The JSONL line of a request row."""
    body = F.to_json(F.struct("body.model", "body.instructions", "body.input"))
    if _has_text(requests):
        fmt = F.col("body.text.format")
        block = F.concat(
            F.lit(',"text":{"format":{"type":'),
            json_quote(fmt["type"]),
            F.lit(',"name":'),
            json_quote(fmt["name"]),
            F.lit(',"schema":'),
            fmt["schema"],
            F.lit(',"strict":'),
            F.coalesce(fmt["strict"], F.lit(False)).cast("string"),
            F.lit("}}"),
        )
        body = F.concat(body.substr(F.lit(1), F.length(body) - 1), F.coalesce(block, F.lit("")), F.lit("}"))
    head = F.to_json(F.struct("custom_id", "method", "url"))
    return F.concat(head.substr(F.lit(1), F.length(head) - 1), F.lit(',"body":'), body, F.lit("}"))


def line_bytes(line: Column | str) -> Column:
    """Bytes of a line in a file, with its newline."""
    return F.octet_length(line).cast("bigint") + 1


@F.pandas_udf(T.StringType())
def _sanitised(schemas: pd.Series) -> pd.Series:
    clean = lru_cache(maxsize=256)(lambda text: json.dumps(sanitise_json_schema(json.loads(text))))
    return schemas.map(clean, na_action="ignore")


def _with_clean_schemas(requests: DataFrame, schema: Column) -> DataFrame:
    """Requests with ``_format``: each distinct schema is cleaned once and joined back."""
    keyed = requests.withColumn("_schema", schema)
    known = keyed.select(F.col("_schema").alias("_known")).where("_known IS NOT NULL").distinct()
    known = known.withColumn("_format", _sanitised("_known"))
    return keyed.join(known, F.col("_schema") == F.col("_known"), "left")


def to_chat(
    requests: DataFrame, model: str, keep: list[str] | None = None, text_format: dict | None = None
) -> DataFrame:
    """Request rows to ``custom_id, payload`` of a chat endpoint.

    Instructions become the system message, the text parts of an input item
    one message; items without text parts are left out. With ``text_format``,
    the contract block of all requests, the cleaned schema is a constant; else
    it is found for each schema among the requests.
    """
    body = F.col("body")
    system = F.when(
        F.coalesce(body["instructions"], F.lit("")) != "",
        F.array(F.struct(F.lit("system").alias("role"), body["instructions"].alias("content"))),
    ).otherwise(F.array().cast("array<struct<role:string,content:string>>"))
    with_text = F.filter(
        F.transform(
            body["input"], lambda i: F.struct(i["role"], F.filter(i["content"], lambda p: p["type"] == "input_text"))
        ),
        lambda i: F.size(i["col2"]) > 0,
    )
    users = F.transform(
        with_text,
        lambda i: F.struct(
            i["role"].alias("role"),
            F.array_join(F.transform(i["col2"], lambda p: p["text"]), "\n").alias("content"),
        ),
    )
    fields = [
        F.lit(model).alias("model"),
        F.concat(system, F.coalesce(users, F.array().cast("array<struct<role:string,content:string>>"))).alias(
            "messages"
        ),
        F.lit(False).alias("stream"),
    ]
    if _has_text(requests):
        fmt = body["text"]["format"]
        schema = F.when(fmt["type"] == "json_schema", F.coalesce(fmt["schema"], F.lit("{}")))
        if text_format is None:
            requests = _with_clean_schemas(requests, schema)
            clean = F.col("_format")
        else:
            constant = json.dumps(sanitise_json_schema(text_format["format"]["schema"]))
            clean = F.when(schema.isNotNull(), F.lit(constant))
        fields.append(clean.alias("format"))
    return requests.select(*(keep or []), "custom_id", F.struct(*fields).alias("payload"))


# Checks of a request set.


def _violation(malformed: str | None = None) -> Column:
    """The first rule of its own that a request breaks, or null."""
    rules = [
        (F.coalesce(F.col("custom_id"), F.lit("")) == "", "missing custom_id"),
        (F.upper(F.coalesce(F.col("method"), F.lit(""))) != METHOD, "method must be POST"),
        (F.coalesce(F.col("url"), F.lit("")) != ENDPOINT, f"url must be {ENDPOINT}"),
        (F.coalesce(F.col("body.model"), F.lit("")) == "", "missing body.model"),
    ]
    reason = F.coalesce(*[F.when(bad, F.lit(text)) for bad, text in rules])
    if malformed:
        reason = F.when(F.col(malformed), F.lit("invalid JSON")).otherwise(reason)
    return reason


def request_violations(requests: DataFrame, malformed: str | None = None) -> DataFrame:
    """``custom_id, reason`` of every request that breaks a rule of its own.

    Rules over several rows are in ``duplicate_ids`` and ``request_summary``.
    """
    return requests.select("custom_id", _violation(malformed).alias("reason")).where(F.col("reason").isNotNull())


def duplicate_ids(requests: DataFrame) -> DataFrame:
    """``custom_id, n`` of ids used more than once."""
    return requests.groupBy("custom_id").agg(F.count("*").alias("n")).where("n > 1")


def request_summary(requests: DataFrame) -> DataFrame:
    """One row: counts of requests, broken rules and models; ``model`` if there is one.

    Ids and models are counted in two levels, so a frequent value is combined
    before it is shuffled.
    """
    model = F.coalesce(F.col("body.model"), F.lit(""))
    by_model = requests.groupBy(model.alias("model")).agg(
        F.count("*").alias("n"),
        F.count_if(F.coalesce(F.col("custom_id"), F.lit("")) == "").alias("missing_id"),
        F.count_if(F.upper(F.coalesce(F.col("method"), F.lit(""))) != METHOD).alias("bad_method"),
        F.count_if(F.coalesce(F.col("url"), F.lit("")) != ENDPOINT).alias("bad_url"),
    )
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(a) for c, a in
            [("n", "total_requests"), ("missing_id", "missing_id"), ("bad_method", "bad_method"), ("bad_url", "bad_url")]]
    return by_model.agg(
        *sums,
        F.coalesce(F.sum(F.when(F.col("model") == "", F.col("n"))), F.lit(0)).alias("missing_model"),
        F.count_if(F.col("model") != "").alias("models"),
        F.min(F.when(F.col("model") != "", F.col("model"))).alias("model"),
    )


def require_valid_requests(requests: DataFrame, malformed: str | None = None) -> DataFrame:
    """The requests, once all checks have passed; else ``ValueError``."""
    # Two passes: one for the rows and their models, one for ids, which alone needs a shuffle.
    marked = requests.withColumn("_model", F.coalesce(F.col("body.model"), F.lit("")))
    reasons = _violation(malformed)
    summary = marked.agg(
        F.count("*").alias("total"),
        F.min(F.when(reasons.isNotNull(), F.concat(F.coalesce("custom_id", F.lit("")), F.lit(": "), reasons))).alias("broken"),
        F.min("_model").alias("first_model"),
        F.max("_model").alias("last_model"),
    ).head()
    if summary.broken:
        raise ValueError(summary.broken)
    repeated = duplicate_ids(requests).take(1)
    if repeated:
        raise ValueError(f"duplicate custom_id {repeated[0].custom_id!r}")
    if summary.total == 0:
        raise ValueError("no requests")
    if summary.first_model != summary.last_model:
        raise ValueError(f"mixed models: {summary.first_model!r}, {summary.last_model!r}")
    return requests

"""Scoring of requests by a caller's function, and what comes back."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from promptframe.operators.ordering import round_robin
from promptframe.sources import score_log
from promptframe.sources.steps import write_step
from promptframe.sources.storage import names_in

# Attempts per request and the pause after the first failed one.
MAX_ATTEMPTS = 3
BACKOFF_SECONDS = 2.0

RESPONSE = (
    "struct<message:struct<content:string>,model:string,prompt_eval_count:long,eval_count:long,"
    "total_duration:long,load_duration:long,prompt_eval_duration:long,eval_duration:long>"
)
_FIELDS = {
    "seq": "long",
    "custom_id": "string",
    "endpoint": "string",
    "response": "string",
    "error": "struct<code:string,message:string>",
    "attempts": "int",
    "duration_ms": "double",
}
_RESULT = ", ".join(f"{name} {kind}" for name, kind in _FIELDS.items())
_COLUMNS = list(_FIELDS)


def dealt_requests(chats: DataFrame, endpoints: list[str], parallel: int, shards: int, seq: str = "seq") -> DataFrame:
    """``seq, custom_id, payload, slot``, a slot a partition, in the order of ``seq``.

    Shard ``slot % shards`` has ``parallel`` slots, and a slot calls one request
    after the other, so a shard never has more than ``parallel`` calls in flight,
    whatever the speed of other endpoints.
    """
    slots = shards * parallel
    dealt = chats.select(
        F.col(seq).alias("seq"), "custom_id", F.to_json("payload").alias("payload"), round_robin(seq, slots).alias("slot")
    )
    return dealt.repartitionById(slots, F.col("slot")).sortWithinPartitions("seq")


def caller(
    scorer: Callable[[dict, str], dict],
    endpoints: list[str],
    shards: int,
    transient: tuple[type[Exception], ...],
    max_attempts: int,
    backoff: float,
    on_error: str,
) -> Callable[[dict], tuple]:
    """What makes a row of results of a row of ``dealt_requests``."""

    def call(row: dict) -> tuple:
        endpoint = endpoints[row["slot"] % shards % len(endpoints)]
        for attempt in range(1, max_attempts + 1):
            began = time.perf_counter()
            try:
                answer, error = json.dumps(scorer(json.loads(row["payload"]), endpoint)), None
            except Exception as raised:
                retry = isinstance(raised, transient)
                if not retry and on_error == "fail":
                    raise
                if retry and attempt < max_attempts:
                    time.sleep(backoff * attempt)
                    continue
                answer, error = None, {"code": type(raised).__name__, "message": str(raised)}
            spent = (time.perf_counter() - began) * 1000
            return row["seq"], row["custom_id"], endpoint, answer, error, attempt, spent

    return call


def _parsed(results: DataFrame) -> DataFrame:
    return results.withColumn("response", F.from_json("response", RESPONSE))


def run_inference(
    chats: DataFrame,
    scorer: Callable[[dict, str], dict],
    endpoints: list[str],
    parallel: int = 1,
    shards: int | None = None,
    seq: str = "seq",
    transient: tuple[type[Exception], ...] = (ConnectionError, TimeoutError),
    max_attempts: int = MAX_ATTEMPTS,
    backoff: float = BACKOFF_SECONDS,
    on_error: str = "fail",
) -> DataFrame:
    """Call ``scorer(payload, endpoint)`` for each row of ``seq, custom_id, payload``.

    Requests are dealt round robin to ``shards`` (as many as endpoints, if not
    given), and shards round robin to endpoints; an endpoint that is listed
    twice gets two shares. Each shard has ``parallel`` partitions, which bounds
    its calls in flight. Transient errors are tried again after a
    growing pause and end as an error row; any other error fails the job or,
    with ``on_error="record"``, also ends as an error row. A task may run
    twice, so write the result once before using it, or use ``score_committed``.
    """
    shards = shards or len(endpoints)
    call = caller(scorer, endpoints, shards, transient, max_attempts, backoff, on_error)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([call(row) for row in batch.to_dict("records")], columns=_COLUMNS)

    return _parsed(dealt_requests(chats, endpoints, parallel, shards, seq).mapInPandas(run, _RESULT))


def score_committed(
    chats: DataFrame,
    scorer: Callable[[dict, str], dict],
    folder: str,
    endpoints: list[str],
    parallel: int = 1,
    shards: int | None = None,
    seq: str = "seq",
    transient: tuple[type[Exception], ...] = (ConnectionError, TimeoutError),
    max_attempts: int = MAX_ATTEMPTS,
    backoff: float = BACKOFF_SECONDS,
    on_error: str = "fail",
    block_rows: int = score_log.ROWS_PER_BLOCK,
) -> DataFrame:
    """``run_inference`` in one job whose results are durable as they are made.

    Every ``block_rows`` results of a partition are committed to the log in
    ``folder``. What has been scored is known by its row, ``seq`` and
    ``custom_id``, and by nothing else: a rerun, also one with more requests or
    other endpoints, sends the requests that have no row yet. ``chats`` has to
    be a table, so that a retried task meets the same rows.
    """
    spark = chats.sparkSession
    shards = shards or len(endpoints)
    run = score_log.close_runs(spark, folder)
    done = score_log.read_log(spark, folder, _RESULT)
    todo = chats
    if done is not None:
        known = done.select(F.col("seq").alias("_seq"), F.col("custom_id").alias("_id"))
        todo = chats.join(known, (F.col(seq) == F.col("_seq")) & F.col("custom_id").eqNullSafe(F.col("_id")), "left_anti")
    if done is None or not todo.isEmpty():
        call = caller(scorer, endpoints, shards, transient, max_attempts, backoff, on_error)
        source = score_log.sink(lambda rows: [call(row) for row in rows], to_arrow_schema(StructType.fromDDL(_RESULT)))
        score_log.append_run(dealt_requests(todo, endpoints, parallel, shards, seq), folder, run, source, block_rows)
        score_log.close_runs(spark, folder)
        done = score_log.read_log(spark, folder, _RESULT)
    return _parsed(spark.createDataFrame([], _RESULT) if done is None else done)


def score_resumable(
    chats: DataFrame, score: Callable[[DataFrame], DataFrame], folder: str, rows_per_round: int, seq: str = "seq"
) -> DataFrame:
    """Score by a function of frames, in rounds that are each written before the next begins.

    For scorers that are a frame operation of their own; ``score_committed`` is
    for functions of one request. What has been scored is known by its row,
    whether or not the round that wrote it has ended.
    """
    spark = chats.sparkSession
    rows = chats.agg(F.coalesce(F.max(seq) + 1, F.lit(0))).head()[0]
    for first in range(0, max(rows, 1), rows_per_round):
        here = F.col(seq).between(first, first + rows_per_round - 1)
        todo = chats.where(here)
        if any(n.endswith(".parquet") for n in names_in(spark, folder)):
            done = spark.read.parquet(folder).where(here).select(F.col(seq).alias("_seq"), F.col("custom_id").alias("_id"))
            # One round of ids at most on the right.
            todo = todo.join(done, (F.col(seq) == F.col("_seq")) & F.col("custom_id").eqNullSafe(F.col("_id")), "left_anti")
            if todo.isEmpty():
                continue
        score(todo).write.mode("append").parquet(folder)
    return spark.read.parquet(folder)


def output_records(scored: DataFrame, provider: str = "chat", with_ids: bool = False, keep: list[str] | None = None) -> DataFrame:
    """Chat responses to output records ``custom_id, error, response``.

    Exactly one of ``error`` and ``response`` is set. Random ids are added only
    on request, since they differ from run to run.
    """
    r = F.col("response")

    def number(name: str) -> Column:
        return F.coalesce(r[name], F.lit(0).cast("long")).alias(name)

    def new_id() -> Column:
        return F.concat(F.lit(f"{provider}_"), F.replace(F.uuid(), F.lit("-"), F.lit("")))

    text = F.struct(
        F.lit("output_text").alias("type"), F.coalesce(r["message"]["content"], F.lit("")).alias("text")
    )
    message = F.struct(F.lit("message").alias("type"), F.array(text).alias("content"))
    usage = F.struct(
        number("prompt_eval_count").alias("input_tokens"), number("eval_count").alias("output_tokens")
    )
    durations = ["total_duration", "load_duration", "prompt_eval_duration", "eval_duration"]
    meta = F.struct(F.coalesce(r["model"], F.lit("")).alias("model"), *[number(d) for d in durations])
    body = [F.array(message).alias("output"), usage.alias("usage"), F.struct(meta.alias(provider)).alias("provider_meta")]
    response = [F.lit(200).alias("status_code")]
    if with_ids:
        body.insert(0, new_id().alias("id"))
        response.insert(0, new_id().alias("request_id"))
    response.append(F.struct(*body).alias("body"))
    ok = F.col("error").isNull()
    return scored.select(*(keep or []), "custom_id", "error", F.when(ok, F.struct(*response)).alias("response"))


def record_line(records: DataFrame) -> Column:
    """The JSONL line of an output record; the unset side is written as null."""
    ids = [c for c in ("custom_id", "error", "response") if c in records.columns]
    return F.to_json(F.struct(*ids), {"ignoreNullFields": "false"})


def split_outputs(records: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """Write all records once; return the successes and the errors of that table."""
    written = write_step(records, folder, "outputs")
    return written.where(F.col("error").isNull()), written.where(F.col("error").isNotNull())


def write_outputs(records: DataFrame, folder: str, seq: str = "seq") -> None:
    """``output.jsonl`` and ``errors.jsonl`` folders of lines, each file in request order.

    The records are worked out once: they are written before they are split.
    """
    lines = records.select(seq, F.col("error").isNull().alias("fine"), record_line(records).alias("value"))
    ordered = write_step(lines, folder, "_lines").orderBy(seq)
    for name, side in (("output.jsonl", F.col("fine")), ("errors.jsonl", ~F.col("fine"))):
        ordered.where(side).select("value").write.mode("overwrite").text(f"{folder}/{name}")


def usage_totals(records: DataFrame, provider: str = "chat") -> DataFrame:
    """``model, requests, input_tokens, output_tokens`` summed over the successes."""
    body = F.col("response.body")
    usable = records.where(F.col("error").isNull())
    return usable.groupBy(body["provider_meta"][provider]["model"].alias("model")).agg(
        F.count("*").alias("requests"),
        F.sum(body["usage"]["input_tokens"]).alias("input_tokens"),
        F.sum(body["usage"]["output_tokens"]).alias("output_tokens"),
    )


def submission_summary(results: DataFrame, keys: list[str], seconds: Column | None = None) -> DataFrame:
    """Completed and failed requests per key, status, and speed if a duration is given."""
    totals = [
        F.count("*").alias("total_requests"),
        F.count_if(F.col("error").isNull()).alias("completed_requests"),
        F.count_if(F.col("error").isNotNull()).alias("failed_requests"),
    ]
    if seconds is not None:
        totals.append(seconds.alias("duration_seconds"))
    out = results.groupBy(*keys).agg(*totals)
    failed = F.col("failed_requests") > 0
    out = out.withColumn("status", F.when(failed, "completed_with_errors").otherwise("completed"))
    if seconds is not None:
        duration = F.col("duration_seconds")
        speed = F.when(duration > 0, F.col("completed_requests") / duration)
        out = out.withColumn("requests_per_second", speed)
    return out

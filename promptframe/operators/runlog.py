"""What a job reports about itself: events, durations, counters, status, progress."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from promptframe.operators.ordering import with_previous
from promptframe.sources.steps import append_rows, put_rows

# Upper bounds of the duration buckets, in seconds.
STEP_BUCKETS = [0.1, 0.5, 1, 5, 10, 30, 60, 120, 300, 600]
REQUEST_BUCKETS = [0.5, 1, 2, 5, 10, 30, 60, 120, 300]

EVENT = (
    "timestamp timestamp, level string, batch_name string, step string, status string, "
    "message string, custom_id string, duration_ms double"
)


def log_events(spark: SparkSession, folder: str, events: list[dict], keys: Sequence[str] = ()) -> None:
    """Write events of the driver to the run log; unset fields are null.

    Without ``keys`` they are appended. With keys, which are then columns of
    the folder's layout, they take the place of all earlier events of the same
    keys, so a step that is done again leaves one row.
    """
    names = [f.split()[0] for f in EVENT.split(", ")]
    rows = spark.createDataFrame([tuple(e.get(n) for n in names) for e in events], EVENT)
    now = F.current_timestamp()
    rows = rows.withColumns({"timestamp": F.coalesce("timestamp", now), "level": F.coalesce("level", F.lit("INFO"))})
    if keys:
        put_rows(rows.coalesce(1), folder, keys)
    else:
        append_rows(rows.coalesce(1), folder)


def step_statistics(events: DataFrame, step: str = "step", duration: str = "duration_ms") -> DataFrame:
    """``stage, count, total_ms, min_ms, max_ms, mean_ms`` per step."""
    d = F.col(duration)
    return events.groupBy(F.col(step).alias("stage")).agg(
        F.count(d).alias("count"),
        F.sum(d).alias("total_ms"),
        F.min(d).alias("min_ms"),
        F.max(d).alias("max_ms"),
        F.avg(d).alias("mean_ms"),
    )


def duration_histogram(events: DataFrame, keys: Sequence[str], seconds: Column, buckets: Sequence[float]) -> DataFrame:
    """``le, n`` per key: rows at or below each bound; ``+Inf`` counts all."""
    bounds = [*buckets, float("inf")]
    counts = events.groupBy(*keys).agg(*[F.count_if(seconds <= b).alias(f"_b{i}") for i, b in enumerate(bounds)])
    pairs = [F.struct(F.lit(float(b)).alias("le"), F.col(f"_b{i}").alias("n")) for i, b in enumerate(bounds)]
    return counts.select(*keys, F.explode(F.array(*pairs)).alias("p")).select(*keys, "p.le", "p.n")


def outcome_counts(events: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``n`` rows per combination of the keys."""
    return events.groupBy(*keys).agg(F.count("*").alias("n"))


def status_changes(
    polls: DataFrame, batch: str, status: str, at: str, tie: str, ranges: int | None = None
) -> DataFrame:
    """The polls at which a batch had another status than at its poll before.

    All batches are ordered together by batch and time and cut into ranges, so
    a batch with very many polls spreads over tasks.
    """
    seen = with_previous(polls, [batch, at, tie], {"_batch": batch, "_status": status}, ranges)
    same = F.col("_batch").eqNullSafe(F.col(batch)) & F.col("_status").eqNullSafe(F.col(status))
    return seen.where(~same | F.col("_batch").isNull()).select(*polls.columns)


def state_age(changes: DataFrame, batch: str, status: str, at: str, tie: str, now: Column) -> DataFrame:
    """Per batch the current status, since when, and for how many seconds."""
    latest = F.max_by(F.struct(F.col(status).alias("status"), F.col(at).alias("since")), F.struct(at, tie))
    current = changes.groupBy(batch).agg(latest.alias("s")).select(batch, "s.*")
    age = F.greatest(F.lit(0.0), now.cast("double") - F.col("since").cast("timestamp").cast("double"))
    return current.withColumn("state_elapsed_seconds", age)


def progress(counts: DataFrame, total: str, completed: str, failed: str, elapsed: str) -> DataFrame:
    """Progress columns from counters; speed and time left are null while unknown."""
    processed = F.col(completed) + F.col(failed)
    whole = F.greatest(F.col(total), processed)
    remaining = F.greatest(F.lit(0), whole - processed)
    seconds = F.greatest(F.lit(0.0), F.col(elapsed).cast("double"))
    speed = F.when((seconds > 0) & (processed > 0), processed / seconds)
    return counts.withColumns(
        {
            "total_requests": whole,
            "processed_requests": processed,
            "remaining_requests": remaining,
            "percent_complete": F.when(whole > 0, processed / whole * 100.0).otherwise(F.lit(0.0)),
            "elapsed_seconds": seconds,
            "speed_items_per_sec": speed,
            "eta_seconds": F.when((speed > 0) & (remaining > 0), remaining / speed),
        }
    )

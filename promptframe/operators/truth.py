"""Predictions joined to ground truth: by id, else by name prefix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptframe.functions.answers import as_string, kind, member
from promptframe.functions.numbers import to_double
from promptframe.functions.text import strip
from promptframe.session import durable

# Rows of a prefix map up to which it is sent to every task.
BROADCAST_PREFIXES = 100_000
# Shares of the ids of one prefix beyond that.
SALTS = 16


def predicted_label(value: Column) -> Column:
    """Label text stripped and in lower case: missing is ``""``, JSON null ``none``."""
    text = F.when(F.is_variant_null(value), F.lit("none")).otherwise(F.lower(strip(as_string(value))))
    return F.when(value.isNull(), F.lit("")).otherwise(text)


def confidence_value(value: Column) -> Column:
    """Number or number text as double, else null."""
    return F.when(kind(value) == "STRING", to_double(strip(as_string(value)))).otherwise(
        F.try_variant_get(value, "$", "double")
    )


def predictions(valid: DataFrame, label_field: str = "label", confidence_field: str = "confidence") -> DataFrame:
    """``custom_id, predicted, confidence, data, raw_text`` of valid answers."""
    return valid.select(
        "custom_id",
        predicted_label(member(F.col("data"), label_field)).alias("predicted"),
        confidence_value(member(F.col("data"), confidence_field)).alias("confidence"),
        *[c for c in ("data", "raw_text") if c in valid.columns],
    )


def name_prefix(custom_id: Column | str) -> Column:
    """What stands before the first double underscore, null where there is none."""
    custom_id = F.col(custom_id) if isinstance(custom_id, str) else custom_id
    return F.when(custom_id.contains("__"), F.lower(strip(F.substring_index(custom_id, "__", 1))))


def join_truth(rows: DataFrame, truth: DataFrame) -> DataFrame:
    """Add ``by_id``: the truth label of the row's id. ``truth`` has one row per ``filename``.

    The truth is cut off first, so that it enters the join by a plain shuffle:
    only then can adaptive execution split a partition of rows that share an id.
    """
    known = durable(truth).select(F.col("filename").alias("custom_id"), F.col("label").alias("by_id"))
    return rows.join(known, "custom_id", "left")


def join_prefix(rows: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Add ``by_prefix``: the label of the row's name prefix, verbatim.

    The map is sent to every task only when it is short; a longer one is
    joined as Spark decides.
    """
    known = prefixes.select(F.col("prefix").alias("_prefix"), F.col("label").alias("by_prefix"))
    named = rows.withColumn("_prefix", name_prefix("custom_id"))
    if known.limit(BROADCAST_PREFIXES + 1).count() <= BROADCAST_PREFIXES:
        return named.join(F.broadcast(known), "_prefix", "left").drop("_prefix")
    # Beyond it: ids without a prefix have nothing to look for and stay out of the shuffle; the few
    # prefixes that very many ids share are spread, each over copies of its one row of the map.
    salted = named.where("_prefix IS NOT NULL").withColumn("_salt", F.pmod(F.xxhash64("custom_id"), F.lit(SALTS)))
    copies = known.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).cast("long"))
    found = salted.join(copies, ["_prefix", "_salt"], "left").drop("_prefix", "_salt")
    rest = named.where("_prefix IS NULL").withColumn("by_prefix", F.lit(None).cast("string")).drop("_prefix")
    return found.unionByName(rest)


def resolve_truth(rows: DataFrame, truth: DataFrame | None = None, prefixes: DataFrame | None = None) -> DataFrame:
    """Add ``ground_truth``; rows without one leave.

    A label found by id counts even when it is empty; the prefix is asked only
    where the id is unknown.
    """
    found = []
    if truth is not None:
        rows = join_truth(rows, truth)
        found.append("by_id")
    if prefixes is not None:
        rows = join_prefix(rows, prefixes)
        found.append("by_prefix")
    if not found:
        return rows.withColumn("ground_truth", F.lit(None).cast("string")).where(F.lit(False))
    return rows.withColumn("ground_truth", F.coalesce(*found)).where(F.col("ground_truth").isNotNull()).drop(*found)

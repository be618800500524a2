"""Filter and transform chains with a record of every drop and failure."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import groupby

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promptframe.functions.frames import compute_once
from promptframe.functions.text import squeeze_whitespace, strip

REJECT = "reject"
TRANSFORM_ERRORS = "transform_errors"


@dataclass(frozen=True)
class Filter:
    """A named row test: rows where ``rejects`` holds are dropped for ``reason``.

    A null test result keeps the row.
    """

    name: str
    rejects: Column
    reason: Column


@dataclass(frozen=True)
class Transform:
    """A named step on the whole frame, made of column expressions."""

    name: str
    apply: Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class RowTransform:
    """A named Python step on one row given as a dict; it may raise."""

    name: str
    apply: Callable[[dict], dict]


@dataclass(frozen=True)
class PythonFilter:
    """A named row test in Python: ``test(*values) -> (keep, reason)``."""

    name: str
    test: Callable[..., tuple[bool, str]]
    columns: tuple[str, ...]


def python_filter(name: str, test: Callable[..., tuple[bool, str]], *columns: str) -> PythonFilter:
    """A filter from a Python function ``(*values) -> (keep, reason)``."""
    return PythonFilter(name, test, columns)


_VERDICT = "struct<filter:string,reason:string>"


def _native_verdict(filters: Sequence[Filter], before: Column) -> Column:
    verdict = F.lit(None).cast(_VERDICT)
    for f in reversed(filters):
        hit = F.struct(F.lit(f.name).alias("filter"), f.reason.alias("reason"))
        verdict = F.when(f.rejects, hit).otherwise(verdict)
    return F.when(before.isNotNull(), before).otherwise(verdict)


def _python_verdict(filters: Sequence[PythonFilter], before: Column) -> Column:
    """One pass for neighbouring Python filters; each test sees only rows that are still kept.

    Spark works a Python function out before the CASE around it, so the rows
    to leave alone are named to the function itself.
    """
    names = list(dict.fromkeys(c for f in filters for c in f.columns))
    places = [[names.index(c) for c in f.columns] for f in filters]

    def first_rejection(values: tuple) -> tuple:
        for f, own in zip(filters, places):
            keep, reason = f.test(*[values[k] for k in own])
            if not keep:
                return f.name, reason
        return None, None

    @F.pandas_udf("filter string, reason string")
    def judge(is_kept: pd.Series, *values: pd.Series) -> pd.DataFrame:
        rows = zip(*values) if values else ((),) * len(is_kept)
        found = [first_rejection(row) if ask else (None, None) for ask, row in zip(is_kept, rows)]
        return pd.DataFrame(found, columns=["filter", "reason"], index=is_kept.index)

    judged = judge(before.isNull(), *[F.col(c) for c in names])
    return F.when(before.isNotNull(), before).when(judged["filter"].isNotNull(), judged)


def mark_rejects(df: DataFrame, filters: Sequence[Filter | PythonFilter]) -> DataFrame:
    """Add ``reject struct<filter,reason>``: the first filter that rejects, or null.

    No filter is evaluated on a row that an earlier one rejected, also not one
    that ``df`` already marks in ``reject``. No row leaves, so kept rows and
    audit come from one scan.
    """
    if REJECT not in df.columns:
        df = df.withColumn(REJECT, F.lit(None).cast(_VERDICT))
    for is_python, group in groupby(filters, lambda f: isinstance(f, PythonFilter)):
        make = _python_verdict if is_python else _native_verdict
        df = compute_once(df, **{REJECT: make(list(group), F.col(REJECT))})
    return df


def kept(marked: DataFrame) -> DataFrame:
    return marked.where(F.col(REJECT).isNull()).drop(REJECT)


def drop_audit(marked: DataFrame, step: str | None = None) -> DataFrame:
    """``filename, filter, reason`` of the dropped rows, with the step if given."""
    dropped = marked.where(F.col(REJECT).isNotNull())
    columns = [F.col("custom_id").alias("filename"), F.col(f"{REJECT}.filter"), F.col(f"{REJECT}.reason")]
    return dropped.select(*([F.lit(step).alias("step")] if step else []), *columns)


def filter_counts(marked: DataFrame) -> DataFrame:
    """``filter, n``: dropped rows per filter, kept rows under ``(kept)``."""
    return marked.groupBy(F.coalesce(f"{REJECT}.filter", F.lit("(kept)")).alias("filter")).agg(F.count("*").alias("n"))


def run_transforms(df: DataFrame, transforms: Sequence[Transform | RowTransform]) -> DataFrame:
    """Apply the transforms in order.

    Neighbouring Python transforms share one pass over Arrow batches. A Python
    transform that raises leaves the row as it was and is noted in
    ``transform_errors``; the row goes on to the next one. Rows marked in
    ``reject`` pass Python transforms as they are.
    """
    steps: list = []
    for t in transforms:
        if isinstance(t, RowTransform) and steps and isinstance(steps[-1], list):
            steps[-1].append(t)
        else:
            steps.append([t] if isinstance(t, RowTransform) else t)
    return reduce(lambda d, s: _python_pass(d, s) if isinstance(s, list) else s.apply(d), steps, df)


def _with_maps(value, kind: T.DataType, as_map: Callable):
    """The value with every map in it rebuilt by ``as_map``; Arrow gives and takes maps as pairs."""
    if value is None:
        return None
    if isinstance(kind, T.MapType):
        pairs = value.items() if isinstance(value, dict) else value
        return as_map((k, _with_maps(v, kind.valueType, as_map)) for k, v in pairs)
    if isinstance(kind, T.ArrayType):
        return [_with_maps(v, kind.elementType, as_map) for v in value]
    if isinstance(kind, T.StructType):
        return {f.name: _with_maps(value[f.name], f.dataType, as_map) for f in kind}
    return value


def _python_pass(df: DataFrame, steps: list[RowTransform]) -> DataFrame:
    earlier = TRANSFORM_ERRORS in df.columns
    if not earlier:
        empty = F.array().cast("array<struct<step:string,error:string>>")
        df = df.withColumn(TRANSFORM_ERRORS, empty)
    schema = df.schema

    def change(row: dict) -> dict:
        if row.get(REJECT) is not None:
            return row
        for step in steps:
            try:
                row = {**row, **step.apply({k: v for k, v in row.items() if k not in (TRANSFORM_ERRORS, REJECT)})}
            except Exception as error:
                note = {"step": step.name, "error": f"{type(error).__name__}: {error}"}
                row = {**row, TRANSFORM_ERRORS: [*row[TRANSFORM_ERRORS], note]}
        return row

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = (_with_maps(r, schema, dict) for r in batch.to_pylist())
            changed = [_with_maps(change(r), schema, list) for r in rows]
            yield pa.RecordBatch.from_pylist(changed, schema=batch.schema)

    return df.mapInArrow(run, schema)


# Filters and transforms of the two built-in recipes.

# Phrases in the subject of automatic replies, in order of mention.
AUTO_REPLY_PHRASES = [
    "out of office",
    "automatic reply",
    "auto-reply",
    "autoreply",
    "delivery status notification",
    "undeliverable",
    "vacation reply",
]


def empty_body_filter(body: str = "body", min_chars: int = 10) -> Filter:
    short = F.coalesce(F.length(strip(body)), F.lit(0)) < min_chars
    return Filter("empty_body", short, F.lit(f"body is empty or too short (<{min_chars} chars)"))


def min_length_filter(body: str = "body", min_chars: int = 20) -> Filter:
    length = F.coalesce(F.length(strip(body)), F.lit(0))
    reason = F.concat(F.lit("body too short ("), length.cast("string"), F.lit(f" < {min_chars} chars)"))
    return Filter("min_length", length < min_chars, reason)


def auto_reply_filter(headers: str = "headers") -> Filter:
    subject = F.lower(F.coalesce(F.col(headers)["Subject"], F.lit("")))
    hits = [F.when(subject.contains(p), F.lit(f"auto-reply detected: '{p}'")) for p in AUTO_REPLY_PHRASES]
    reason = F.coalesce(*hits)
    return Filter("auto_reply", reason.isNotNull(), reason)


def trim_whitespace(body: str = "body") -> Transform:
    return Transform("trim_whitespace", lambda df: compute_once(df, **{body: squeeze_whitespace(body)}))


def annotate_attachments(metadata: str = "metadata") -> Transform:
    names = F.coalesce(F.col(f"{metadata}.attachment_names"), F.array().cast("array<string>"))
    filled = F.col(metadata).withField("attachment_names", names)
    return Transform("annotate_attachments", lambda df: df.withColumn(metadata, filled))

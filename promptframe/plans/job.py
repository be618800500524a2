"""The steps of a labelling job as lazy plans over DataFrames."""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promptframe.operators import reports, runlog, sharding
from promptframe.operators.chain import REJECT, kept, mark_rejects, run_transforms
from promptframe.operators.contract import Contract
from promptframe.operators.evaluate import Evaluation, evaluate
from promptframe.operators.inference import output_records, run_inference, score_committed, submission_summary
from promptframe.operators.ordering import with_seq
from promptframe.operators.render import line_bytes, override_prompt, render_requests, request_line, require_valid_requests, to_chat
from promptframe.operators.truth import predictions, resolve_truth
from promptframe.operators.validate import quarantine, records_as_outputs, valid_rows, validate_outputs
from promptframe.plans.recipes import Recipe
from promptframe.sources.prompts import DEFAULT_PROMPT
from promptframe.sources.score_log import ROWS_PER_BLOCK
from promptframe.sources.steps import is_complete, read_step, write_step
from promptframe.sources.storage import read_text, write_text


STEP = "reject_step"
# The tables of a job, in the order in which they are made.
STEPS = ["marked", "requests", "manifest", "chats", "records", "submissions", "checked", "predictions"]


@dataclass(frozen=True)
class Cleaned:
    """Documents that passed both filter passes, and the audit of those that did not."""

    documents: DataFrame
    dropped: DataFrame


def mark_documents(documents: DataFrame, recipe: Recipe) -> DataFrame:
    """Filter, transform, filter again, in one pass: every row with its ``reject`` and ``reject_step``.

    Python filters and transforms see only rows that are still kept; column
    transforms apply to all rows.
    """
    rejected = F.col(REJECT).isNotNull()
    first = mark_rejects(documents, recipe.filters).withColumn(STEP, F.when(rejected, "filter_1"))
    second = mark_rejects(run_transforms(first, recipe.transforms), recipe.filters_after)
    return second.withColumn(STEP, F.coalesce(STEP, F.when(rejected, F.lit("filter_2"))))


def split_marked(marked: DataFrame) -> Cleaned:
    dropped = marked.where(F.col(REJECT).isNotNull())
    audit = dropped.select(
        F.col(STEP).alias("step"), F.col("custom_id").alias("filename"), f"{REJECT}.filter", f"{REJECT}.reason"
    )
    return Cleaned(kept(marked).drop(STEP), audit)


def clean_documents(documents: DataFrame, recipe: Recipe) -> Cleaned:
    """Filter, transform, filter again; write ``mark_documents`` first where both results are used."""
    return split_marked(mark_documents(documents, recipe))


def requests_of(documents: DataFrame, recipe: Recipe, model: str, instructions: str = DEFAULT_PROMPT) -> DataFrame:
    """Request rows of cleaned documents."""
    block = recipe.contract.text_format() if recipe.contract else None
    return render_requests(documents, recipe.reader.package(), model, instructions, block)


def chats_of(requests: DataFrame, model: str, prompt: str | None = None, contract: Contract | None = None) -> DataFrame:
    """``seq, custom_id, payload``: numbered chat payloads of requests, with the prompt replaced if given."""
    numbered = with_seq(override_prompt(requests, prompt), ["custom_id"])
    return to_chat(numbered, model, keep=["seq"], text_format=contract.text_format() if contract else None)


def answers_of(chats: DataFrame, scorer: Callable, **options) -> DataFrame:
    """``seq`` and output record of each chat payload."""
    return output_records(run_inference(chats, scorer, **options), keep=["seq"])


def transformed_rows(valid: DataFrame, recipe: Recipe) -> DataFrame:
    """Valid rows after the recipe's own output step, if it has one."""
    return valid.transform(recipe.output_transform) if recipe.output_transform else valid


def prediction_rows(
    valid: DataFrame,
    contract: Contract | None,
    truth: DataFrame | None = None,
    prefixes: DataFrame | None = None,
    label_field: str | None = None,
    confidence_field: str | None = None,
) -> DataFrame:
    """Valid rows as predictions with their ground truth.

    A named field wins over the one the contract suggests.
    """
    label = (contract.label_field(label_field) if contract else label_field) or "label"
    confidence = (contract.confidence_field(confidence_field) if contract else confidence_field) or "confidence"
    return resolve_truth(predictions(valid, label, confidence), truth, prefixes)


@dataclass(frozen=True)
class JobResult:
    dropped: DataFrame
    requests: DataFrame
    records: DataFrame
    valid: DataFrame
    rejected: DataFrame
    evaluation: Evaluation | None


def job_fingerprint(documents: DataFrame, recipe: Recipe, **settings) -> str:
    """A hash of what decides a job's results: recipe, settings, and the input's files and columns."""
    contract = json.dumps(recipe.contract.text_format(), sort_keys=True) if recipe.contract else ""
    names = [[f.name for f in group] for group in (recipe.filters, recipe.transforms, recipe.filters_after)]
    known = [recipe.name, names, contract, documents.schema.simpleString(), sorted(documents.inputFiles()), settings]
    return hashlib.sha256(json.dumps(known, sort_keys=True).encode()).hexdigest()


def write_shard_files(requests: DataFrame, folder: str, max_requests: int, max_bytes: int) -> DataFrame:
    """Request lines in files within both bounds, and the manifest of these files."""
    lines = requests.select("custom_id", request_line(requests).alias("line"))
    packed = sharding.pack(lines, ["custom_id"], line_bytes("line"), max_requests, max_bytes)
    sharding.write_shards(packed, F.col("line"), f"{folder}/shards", ["custom_id"])
    return sharding.shard_manifest(requests.sparkSession, f"{folder}/shards")


def export_job(result: JobResult, folder: str, contract: Contract | None = None) -> None:
    """The report tables of a job, as CSV folders, and the evaluation as JSON."""
    columns = reports.resolve_columns(result.valid, contract)
    tables = {"results": reports.results_table(result.valid, columns), "dropped": result.dropped}
    tables["result_cells"] = reports.result_cells(result.valid, columns)
    found = result.evaluation
    if found:
        tables |= {"predictions": reports.prediction_table(found.predictions, contract), "per_class": found.per_class}
        tables |= {"summary": found.summary, "confusion": found.counts}
        if found.roc is not None:
            tables["roc"] = found.roc
        reports.write_evaluation_json(found, f"{folder}/evaluation.json")
        reports.write_confusion_cells(found, f"{folder}/confusion_cells")
    for name, table in tables.items():
        reports.write_table(table, f"{folder}/{name}")


def run_job(
    documents: DataFrame,
    recipe: Recipe,
    scorer: Callable,
    folder: str,
    model: str,
    instructions: str = DEFAULT_PROMPT,
    truth: DataFrame | None = None,
    prefixes: DataFrame | None = None,
    positive: str | None = None,
    prompt: str | None = None,
    resume: bool = False,
    rows_per_round: int = ROWS_PER_BLOCK,
    max_requests: int = sharding.MAX_REQUESTS,
    max_bytes: int = sharding.MAX_BYTES,
    export: bool = True,
    **inference,
) -> JobResult:
    """All steps on parsed documents; each result is a table in ``folder``.

    Documents are read once: the filter passes write one marked table, and the
    audit and the requests come from it. Requests are checked (ids, models)
    before any is scored. ``resume`` goes on from the tables, and the scored
    requests, of an earlier run of the same job; without it ``folder`` has to
    be new. Both are checked before anything is written. Scores are durable
    after every ``rows_per_round`` requests of a partition.
    """
    spark = documents.sparkSession
    own = job_fingerprint(documents, recipe, model=model, instructions=instructions, prompt=prompt)
    earlier = read_text(spark, f"{folder}/job.txt")
    if not resume and (earlier or any(is_complete(spark, f"{folder}/{s}") for s in STEPS)):
        raise ValueError(f"{folder} has tables of another run; use resume or a new folder")
    if resume and earlier and earlier.strip() != own:
        raise ValueError(f"{folder} belongs to a job with other settings or inputs")
    write_text(spark, f"{folder}/job.txt", own + "\n")
    began = time.perf_counter()

    def done(name: str) -> None:
        nonlocal began
        now = time.perf_counter()
        event = {"batch_name": recipe.name, "step": name, "status": "completed", "duration_ms": (now - began) * 1000}
        runlog.log_events(spark, f"{folder}/events", [event], keys=["batch_name", "step"])
        began = now

    def step(name: str, make: Callable[[], DataFrame]) -> DataFrame:
        if resume and is_complete(spark, f"{folder}/{name}"):
            return read_step(spark, folder, name)
        table = write_step(make(), folder, name)
        done(name)
        return table

    cleaned = split_marked(step("marked", lambda: mark_documents(documents, recipe)))
    requests = step("requests", lambda: requests_of(cleaned.documents, recipe, model, instructions))
    require_valid_requests(requests)
    step("manifest", lambda: write_shard_files(requests, folder, max_requests, max_bytes))
    chats = step("chats", lambda: chats_of(requests, model, prompt, recipe.contract))

    def scored() -> DataFrame:
        return score_committed(chats, scorer, f"{folder}/scores", block_rows=rows_per_round, **inference)

    records = step("records", lambda: output_records(scored(), keep=["seq"]))
    batch = F.lit(recipe.name).alias("batch")
    step("submissions", lambda: submission_summary(records.select("error", batch), ["batch"]))
    checked = step("checked", lambda: validate_outputs(records_as_outputs(records), recipe.contract))
    valid = transformed_rows(valid_rows(checked), recipe)
    evaluation = None
    if truth is not None or prefixes is not None:
        rows = prediction_rows(valid, recipe.contract, truth, prefixes)
        evaluation = evaluate(step("predictions", lambda: rows), positive)
    result = JobResult(cleaned.dropped, requests, records, valid, quarantine(checked), evaluation)
    if export:
        export_job(result, f"{folder}/export", recipe.contract)
        done("export")
    return result
